"""Writing warehouse tables.

Rows are counted by an ``Observation`` in the stage that writes them: no second
scan, and exact when a lost executor makes tasks run again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, Row, SparkSession
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.clean import align, stamp
from granary.operators.facts import quarantine_records, rejected_rows, valid_rows
from granary.operators.keys import hash_bucket, load_key, same_key
from granary.publish import Move, by_folder, folder_names, publish, put_in_place, recover, whole
from granary.session import at_once, delete_path, path_exists, stage
from granary.sinks.day_sums import stage_sums, sums_moves
from granary.sinks.interleave import with_interleaved_ranks
from granary.sinks.key_index import days_to_open, index_moves, stage_index, stored_days


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows_loaded: int
    rows_rejected: int
    batch_id: str


def batch_name(batch_date: dt.date, batch_ts: dt.datetime) -> str:
    return f"batch_{batch_date:%Y%m%d}_{batch_ts:%H%M%S}"


def stamp_load(df: DataFrame, batch_id: str, batch_ts: dt.datetime) -> DataFrame:
    return df.withColumns(
        {"_batch_id": F.lit(batch_id), "_loaded_at": stamp(batch_ts)}
    )


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A warehouse table under its schema, or ``None`` before its first load."""
    if not path_exists(spark, path):
        return None
    schema = schemas.target_schema(table)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def with_equality_index(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """Bloom filters on ``columns``, sized by their values, so that a lookup skips row groups."""
    if columns:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer


def counted_write(df: DataFrame, write) -> int:
    """Hand ``df`` to ``write`` and return the rows that passed."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def load_dimension(
    df: DataFrame,
    path: str,
    table: str,
    batch_id: str,
    batch_ts: dt.datetime,
    mode: str = "overwrite",
    index: Sequence[str] = (),
) -> LoadResult:
    """Write a dimension with its load stamp; ``overwrite`` it whole or ``append``.

    ``df`` must not read ``path``: stage it first.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is 'overwrite' or 'append', not {mode!r}; merging is merge_into")
    rows = counted_write(
        stamp_load(df, batch_id, batch_ts),
        lambda d: with_equality_index(d.write.mode(mode), index).parquet(path),
    )
    return LoadResult(table, rows, 0, batch_id)


#: Buckets by key that a new history is stored in. A stored one keeps the number it has.
HISTORY_BUCKETS = 64
_BUCKET = "key_bucket"


def key_bucket(key: str, buckets: int) -> Column:
    """Bucket of a key in a stored history. Their number is part of the name, so the folders tell it."""
    return F.concat(F.lit(f"{buckets}_"), hash_bucket([key], buckets).cast("string"))


def load_history(
    df: DataFrame,
    path: str,
    table: str,
    key: str,
    batch_id: str,
    batch_ts: dt.datetime,
    index: Sequence[str] = (),
    buckets: int = HISTORY_BUCKETS,
) -> LoadResult:
    """Write the versions a batch touched, in folders by closing day and bucket of ``key``.

    ``path`` is a staging folder, whose folders take the place of the stored ones
    of the same day and bucket (:func:`history_moves`); the others are neither
    read nor written. A large bucket is cut into several files.
    """
    stamped = stamp_load(df, batch_id, batch_ts).withColumn(_BUCKET, key_bucket(key, buckets))
    rows = counted_write(
        stamped.hint("rebalance", "valid_to", _BUCKET),
        lambda d: with_equality_index(d.write, index).partitionBy("valid_to", _BUCKET).parquet(path),
    )
    return LoadResult(table, rows, 0, batch_id)


def history_moves(spark: SparkSession, staged: str, path: str) -> list[Move]:
    """Staged folders of day and bucket in place of the stored ones. No row ever leaves a folder for good."""
    return [m for day in folder_names(spark, staged) if "=" in day for m in by_folder(spark, f"{staged}/{day}", f"{path}/{day}")]


@dataclass(frozen=True)
class StoredHistory:
    """A history as stored, cut into what a batch may change and what stays."""

    open: DataFrame
    stays: DataFrame
    buckets: int
    highest: int  # surrogate key of the whole table


def history_buckets(spark: SparkSession, path: str) -> int | None:
    """How many buckets a stored history has; ``None`` if there is none, or one without buckets."""
    for day in folder_names(spark, path):
        if day.startswith("valid_to="):
            names = [n for n in folder_names(spark, f"{path}/{day}") if n.startswith(f"{_BUCKET}=")]
            return int(names[0].partition("=")[2].partition("_")[0]) if names else None
    return None


def stored_history(
    spark: SparkSession, path: str, table: str, key: str, sk: str, staged: DataFrame, buckets: int, closed: dt.date
) -> StoredHistory:
    """Cut a history of ``buckets`` at the keys of ``staged``, a small written frame.

    A batch may change the current versions in the buckets of its keys, and those
    ``closed`` on the day before it, by an earlier run of the same batch. Both
    parts are chosen by folder. The names of the buckets come to the driver.
    """
    schema = schemas.target_schema(table)
    rows = spark.read.schema(schemas.target_schema(table).add(_BUCKET, "string")).parquet(path)
    touched = _values(staged.select(key_bucket(key, buckets).alias(_BUCKET)), _BUCKET)
    mine = (F.col("valid_to").isNull() | (F.col("valid_to") == F.lit(closed))) & F.col(_BUCKET).isin(touched) if touched else F.lit(False)
    beside = _top_key(path)
    tops = spark.read.schema("highest long").parquet(beside) if path_exists(spark, beside) else rows.agg(F.max(sk).alias("highest"))
    highest = tops.agg(F.max("highest")).first()[0] or 0
    return StoredHistory(rows.filter(mine).select(*schema.names), rows.filter(~mine).select(*schema.names), buckets, highest)


def _top_key(path: str) -> str:
    return f"{path.rstrip('/')}_top_key"


def stage_top_key(written: DataFrame, sk: str, before: int, staged: str) -> None:
    """Write the highest surrogate key beside a staged history, so that no batch has to look for it."""
    written.agg(F.greatest(F.max(sk), F.lit(before).cast("long")).alias("highest")).write.parquet(_top_key(staged))


def top_key_moves(staged: str, path: str) -> list[Move]:
    return whole(_top_key(staged), _top_key(path))


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` put in place of those with the same key.

    ``updates`` has one row per key.
    """
    kept = target.join(updates, same_key(target, updates, [(k, k) for k in keys]), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def merge_into(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Upsert into a table partitioned by ``partition``, rewriting touched partitions only.

    A partition is touched if an update goes to it or a replaced row lies in it.
    Its values, at most one per folder, come to the driver, so that only those
    folders are read and merged. The result is written beside the table and then
    published as a whole; a folder whose last row moved elsewhere goes. A call
    that was stopped has changed nothing, or is finished by ``recover``.
    """
    recover(spark, path)
    target = spark.read.parquet(path)
    updates = stage(updates, "merge-updates")
    replaced = target.join(updates.select(*keys), list(keys), "left_semi").select(partition)
    touched = _values(replaced.unionByName(updates.select(partition)), partition)
    part = target.filter(
        F.col(partition).isin([v for v in touched if v is not None])
        | (F.col(partition).isNull() & F.lit(None in touched))
    )
    staged = staging_beside(path)
    merge_upsert(part, updates, keys).write.partitionBy(partition).parquet(staged)
    gone = [f for f in {partition_folder(spark, partition, v) for v in touched} if not path_exists(spark, f"{staged}/{f}")]
    put_in_place(spark, staged, path, partitions=True, emptied=gone)


def partition_folder(spark: SparkSession, column: str, value: object) -> str:
    """Name of the folder of a partition value, spelled as Spark's writers do."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}={spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))}"


def staging_beside(path: str) -> str:
    """A fresh folder beside a table, hidden from readers, that outlasts the session as its publication may have to."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staged-{name}-{uuid.uuid4().hex}"


def _values(df: DataFrame, column: str) -> list:
    return [r[0] for r in df.select(column).distinct().collect()]


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    tie: str,
    partition: str | None = None,
    whole: bool = False,
    index: Sequence[str] = (),
    files: int | None = None,
    interleave: Sequence[str] = (),
) -> int:
    """Write ``df`` ordered by ``columns``, so that filters on them skip files and row groups.

    ``tie``, a column of many values, joins the range boundaries: where many
    rows share the same ``columns`` they are still cut into several parts. With
    ``partition`` the folders found in ``df`` are replaced and others stay,
    unless the ``whole`` table is to be replaced. Below ``columns`` rows can be
    ordered by several numeric columns at once, those to ``interleave``, at the
    cost of one more aggregate over ``df``.
    """
    names = df.columns
    if interleave:
        df = with_interleaved_ranks(df, interleave, "_interleaved")
        columns = [*columns, "_interleaved"]
    bounds = [*columns, tie]
    ranged = df.repartitionByRange(files, *bounds) if files else df.repartitionByRange(*bounds)

    def write(d: DataFrame) -> None:
        writer = with_equality_index(d.write.mode("overwrite"), index)
        if partition:
            writer = writer.partitionBy(partition).option(
                "partitionOverwriteMode", "static" if whole else "dynamic"
            )
        writer.parquet(path)

    return counted_write(ranged.sortWithinPartitions(*columns).select(*names), write)


@dataclass(frozen=True)
class StagedFact:
    """What a batch is about to change in the fact and the quarantine."""

    loaded: int
    refused: int
    outdated: int
    amount: Decimal
    kept: DataFrame | None  # records of earlier batches written again
    fact: str
    quarantine: str
    staging: str
    replaced_days: list[int]  # stored days whose folders go or are written anew
    emptied_records: list[str]
    whole: bool


def _stored(spark: SparkSession, path: str, table: str, partition: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    schema = schemas.target_schema(table)
    if partition not in schema.names:
        schema = schema.add(partition, "date")
    return spark.read.schema(schema).parquet(path)


def _of_days(spark: SparkSession, path: str, days: Sequence[int]) -> DataFrame:
    """Stored facts of some ``days``: the folders of the others aren't listed."""
    schema = schemas.target_schema("fact_transactions")
    if not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/time_sk={d}" for d in days])


def _folders(df: DataFrame, column: str) -> set[str]:
    """Partition folders of the values of ``column``, at most one name a folder."""
    return {f"{column}={v}" for v in _values(df, column)}


def stage_fact(
    flagged: DataFrame,
    path: str,
    quarantine_path: str,
    staging: str,
    run: int,
    batch_date: dt.date,
    window: tuple[dt.date, dt.date] | None = None,
) -> StagedFact:
    """Work out and write under ``staging`` what the fact and the quarantine will hold.

    ``flagged`` has the newest version of each transaction the batch read, with
    the reasons to refuse it. Without ``window`` it is the whole source and
    replaces both tables. Otherwise

    * stored rows of the window's days were read again, and so were all rows
      without a readable date: the batch replaces those;
    * of a transaction stored under another day the newer version stays, in the
      table or in the quarantine, and the older one goes;
    * everything else is left alone.

    So any sequence of batches holds what one full load would. Only folders of
    days with a change are rewritten; their names come to the driver. Stored days
    are opened only where the key index says that they may hold a key of the
    batch (see :mod:`granary.sinks.key_index`).
    """
    spark = flagged.sparkSession
    has_fact = window is not None and path_exists(spark, path)
    held = _stored(spark, quarantine_path, "quarantine_fact_transactions", "batch_date") if window else None
    lo, hi = (int(f"{d:%Y%m%d}") for d in window) if window else (0, 0)
    winners, places = flagged, []
    if has_fact:
        own = {d for d in stored_days(spark, path) if lo <= d < hi}
        outside = _of_days(spark, path, days_to_open(flagged.select("transaction_bk"), path, own))
        places.append(outside.select("transaction_bk", F.col("time_sk").alias("held"), F.lit(True).alias("loaded")))
    if held is not None:
        held = held.withColumn("_day", F.get_json_object("raw_data", "$.time_sk").try_cast("int"))
        again = F.col("_day").isNull() | ((F.col("_day") >= lo) & (F.col("_day") < hi))
        places.append(held.filter(~again).select("transaction_bk", F.col("_day").alias("held"), F.lit(False).alias("loaded")))
    replaced = None
    if places:
        keys = flagged.select("transaction_bk", "time_sk").filter("transaction_bk is not null")
        both = stage(reduce(DataFrame.unionAll, places).join(keys, "transaction_bk"), "stored-versions")
        newer = F.col("held") > F.coalesce("time_sk", F.lit(-1))
        winners = flagged.join(both.filter(newer).select("transaction_bk").distinct(), "transaction_bk", "left_anti")
        replaced = both.filter(~newer)
        winners = stage(winners, "winners")

    def facts_and_index() -> set[int]:
        new = align(valid_rows(winners).withColumn("transaction_sk", load_key(run)), schemas.target_schema("fact_transactions"))
        replaced_days: set[int] = set()
        if has_fact:
            restated = set(_values(replaced.filter("loaded"), "held"))
            replaced_days = restated | own
            stored = outside.filter(F.col("time_sk").isin(sorted(restated)))
            gone = replaced.filter("loaded").select("transaction_bk")
            new = new.unionByName(align(stored.join(gone, "transaction_bk", "left_anti"), schemas.target_schema("fact_transactions")))
        write_clustered(
            new, f"{staging}/fact", ["time_sk", "customer_sk"], tie="transaction_bk",
            partition="time_sk", whole=True, index=["transaction_bk"],
        )
        written = spark.read.schema(schemas.target_schema("fact_transactions")).parquet(f"{staging}/fact")
        beside = (path, staging, replaced_days, window is None)
        at_once(partial(stage_index, written, *beside), partial(stage_sums, written, *beside))
        return replaced_days

    def quarantine() -> tuple[set[str], DataFrame | None]:
        records = align(quarantine_records(rejected_rows(winners)), schemas.target_schema("quarantine_fact_transactions"))
        records = records.withColumn("batch_date", F.lit(batch_date))
        emptied: set[str] = set()
        rest = None
        if held is not None:
            stale = replaced.filter("not loaded").select("transaction_bk").distinct().withColumn("_stale", F.lit(True))
            marked = held.join(stale, "transaction_bk", "left").withColumn("_gone", again | F.coalesce("_stale", F.lit(False)))
            marked = stage(marked.drop("_stale"), "records")
            emptied = _folders(marked.filter("_gone").select("batch_date"), "batch_date")
            touched = {f.split("=")[1] for f in emptied} | {str(batch_date)}
            rest = marked.filter(F.col("batch_date").cast("string").isin(sorted(touched)) & ~F.col("_gone")).select(*records.columns)
            records = records.unionByName(rest)
        records.write.mode("overwrite").partitionBy("batch_date").parquet(f"{staging}/quarantine")
        return emptied, rest

    def counted() -> tuple[Row, int]:
        good = F.size("reasons") == 0
        sums = winners.agg(
            F.count_if(good).alias("loaded"), F.count_if(~good).alias("refused"),
            F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(38,4)").alias("amount"),
        ).first()
        return sums, flagged.count() if winners is not flagged else sums["loaded"] + sums["refused"]

    replaced_days, (emptied_records, rest), (sums, all_rows) = at_once(facts_and_index, quarantine, counted)
    return StagedFact(
        sums["loaded"], sums["refused"], all_rows - sums["loaded"] - sums["refused"], sums["amount"], rest,
        f"{staging}/fact", f"{staging}/quarantine", staging, sorted(replaced_days), sorted(emptied_records), window is None,
    )


def fact_moves(spark: SparkSession, staged: StagedFact, path: str, quarantine_path: str) -> list[Move]:
    """Staged folders in place of the stored ones; a table or folder that got no rows goes."""
    beside = (spark, path, staged.staging, staged.replaced_days, staged.whole)
    moves = index_moves(*beside) + sums_moves(*beside)
    for source, target, emptied in (
        (staged.fact, path, [f"time_sk={d}" for d in staged.replaced_days]),
        (staged.quarantine, quarantine_path, staged.emptied_records),
    ):
        gone = [f for f in emptied if not path_exists(spark, f"{source}/{f}")]
        moves += whole(source, target) if staged.whole else by_folder(spark, source, target, gone)
    return moves


def load_fact(
    flagged: DataFrame,
    path: str,
    quarantine_path: str,
    run: int,
    batch_id: str,
    batch_date: dt.date,
    window: tuple[dt.date, dt.date] | None = None,
) -> LoadResult:
    """Stage and publish a batch's facts, see :func:`stage_fact`."""
    spark, staging = flagged.sparkSession, staging_beside(path)
    staged = stage_fact(flagged, path, quarantine_path, staging, run, batch_date, window)
    publish(spark, path.rpartition("/")[0], fact_moves(spark, staged, path, quarantine_path))
    delete_path(spark, staging)
    return LoadResult("fact_transactions", staged.loaded, staged.refused, batch_id)


def publish_swap(spark: SparkSession, staging: str, production: str) -> None:
    """Exchange two catalog tables by renaming.

    Between the renames ``production`` is missing for a moment: the session
    catalog has no atomic exchange. A call that was stopped is finished by
    calling again: what was renamed already isn't renamed twice.
    """
    aside = f"{production}_swap"
    if spark.catalog.tableExists(production) and not spark.catalog.tableExists(aside):
        spark.sql(f"ALTER TABLE {production} RENAME TO {aside}")
    if not spark.catalog.tableExists(production):
        spark.sql(f"ALTER TABLE {staging} RENAME TO {production}")
    if spark.catalog.tableExists(aside):
        spark.sql(f"ALTER TABLE {aside} RENAME TO {staging}")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, one aggregate per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).orderBy("table_name")
