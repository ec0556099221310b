"""The nightly batch: extract, dimensions, fact, checks, load, audit."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.calendar import FIRST_DAY, LAST_DAY, dim_time
from granary.functions.clean import Mapping as ColumnMapping
from granary.functions.clean import null_normalize, parse_date
from granary.operators import quality
from granary.operators.dims import BY_NAME, build_dimension
from granary.operators.facts import (
    flag_rejects,
    is_valid,
    transform_fact,
    valid_rows,
)
from granary.operators.scd2 import (
    CUSTOMER_TRACKED,
    PRODUCT_TRACKED,
    scd2_build,
    stage_customers,
    stage_products,
)
from granary.operators.keys import run_of
from granary.publish import Move, added_files, publish, recover, roll_forward, whole
from granary.session import at_once, batch_folder, delete_path, stage
from granary.sinks.day_sums import read_sums
from granary.sinks.key_index import find_transactions, last_run
from granary.sinks.tables import (
    HISTORY_BUCKETS,
    LoadResult,
    StagedFact,
    StoredHistory,
    batch_name,
    fact_moves,
    history_buckets,
    history_moves,
    load_dimension,
    load_history,
    read_table,
    stage_fact,
    stage_top_key,
    stored_history,
    top_key_moves,
)
from granary.sources.extract import batch_window, in_window
from granary.sources.landing import extract_id, landing_path, read_landing, stamp_extract, write_landing

log = logging.getLogger(__name__)

# The columns that say when a source row last changed.
WATERMARKS = {
    "DIM_PRODUCT": "LAST_UPD_DT",
    "DIM_CUSTOMER": "LAST_UPD_DT",
    "FACT_TXN": "TXN_DT",
}

# Dimensions that keep history, with their business key.
HISTORIES = {"dim_product": "product_bk", "dim_customer": "customer_bk"}

# Days beyond these are taken for wrong, and a row of such a day is refused.
CALENDAR_LIMITS = (dt.date(1900, 1, 1), dt.date(2199, 12, 31))

# Columns that analysts look up by value.
LOOKUP_COLUMNS = {"dim_product": ["product_bk", "isin_code"], "dim_customer": ["customer_bk"]}


@dataclass
class BatchResult:
    batch_id: str
    loads: list[LoadResult]
    report: quality.Report | None
    audit: DataFrame
    source_reports: list[quality.Report]


class Warehouse:
    """Paths and tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/core/{table}"

    def table(self, table: str) -> DataFrame | None:
        return read_table(self.spark, self.path(table), table)

    def recover(self) -> int:
        """Finish a stopped publication, of a whole batch or of a single table; how many of whole batches there were.

        Every batch begins with this. Call it where tables are read after a batch
        that did not come to its end.
        """
        stopped = roll_forward(self.spark, self.root)
        for table in schemas.TARGET_DDL:
            recover(self.spark, self.path(table))
        return stopped

    def next_run(self) -> int:
        """Number of the next run, one more than that of any run so far."""
        audit = self.table("batch_audit")
        last = [audit.agg(F.max("run")).first()[0]] if audit is not None else []
        last.append(last_run(self.spark, self.path("fact_transactions")))
        return max([n for n in last if n is not None], default=0) + 1

    def find_transactions(self, keys: Sequence[str]) -> DataFrame:
        """Facts with one of a few ``keys``, read from the folders of their days alone."""
        path = self.path("fact_transactions")
        return find_transactions(self.spark, path, read_table(self.spark, path, "fact_transactions"), keys)

    def tables(self) -> dict[str, DataFrame]:
        """All model tables loaded so far."""
        found = {t: self.table(t) for t in schemas.TARGET_DDL}
        return {t: df for t, df in found.items() if df is not None}

    def with_sums(self) -> dict[str, DataFrame]:
        """The same with the sums by day kept beside the fact, from which the marts by month and by channel are then read."""
        sums = read_sums(self.spark, self.path("fact_transactions"))
        return self.tables() | ({} if sums is None else {"fact_sums": sums})


def source_totals(raw: DataFrame) -> DataFrame:
    """What the fact has to add up to: rows and net amount of the newest version of each key.

    Derived without the fact's own code: per key the greatest pair of day and
    amount, as one number, so that Spark sums by hash. The day of that pair is
    the greatest day of its key; taken off, the amount is left without a
    division. Rows without a key count one by one.
    """
    amount = F.col("NET_AMT").try_cast("decimal(18,4)")
    day = F.coalesce(F.date_diff(parse_date(F.col("TXN_DT").cast("string")), F.lit("0001-01-01").cast("date")) + 1, F.lit(0))
    # Days above, amounts below; a null amount comes before any other of its day.
    shift, above = F.lit(Decimal(10) ** 15), F.lit(Decimal(10) ** 16)

    def raised(days: Column) -> Column:
        return days.cast("decimal(8,0)") * above

    below = F.coalesce(amount.cast("decimal(38,4)") + shift, F.lit(0)).cast("decimal(38,4)")
    keyless = F.col("TXN_ID").isNull()
    per_key = raw.groupBy("TXN_ID").agg(
        F.max((raised(day) + below).cast("decimal(38,4)")).alias("pair"), F.max(day).alias("day"),
        F.count("*").alias("n"), F.sum(F.when(keyless, amount)).alias("all"),
    )
    last = (F.col("pair") - raised(F.col("day"))).cast("decimal(38,4)")
    return per_key.agg(
        F.sum(F.when(keyless, F.col("n")).otherwise(1)).cast("long").alias("row_count"),
        F.sum(F.when(keyless, F.col("all")).when(last > 0, last - shift)).cast("decimal(38,4)").alias("amount_total"),
    ).na.fill(0)


@dataclass(frozen=True)
class Landed:
    """What one table's extract wrote, and how long it took."""

    rows: int
    extract_id: str
    seconds: float


def window_of(df: DataFrame, table: str, batch_date: dt.date, full: bool, look_back: int) -> DataFrame:
    """What a batch reads of a source table: all of it, or its window and the rows without a readable date."""
    if table not in WATERMARKS or full:
        return df
    return in_window(df, WATERMARKS[table], batch_date, look_back, undated=True)


def extract_all(
    source: Mapping[str, DataFrame],
    wanted: Collection[str],
    root: str,
    batch_date: dt.date,
    batch_ts: dt.datetime,
    full: bool,
    look_back: int = 0,
) -> dict[str, Landed]:
    """Land the wanted tables as they are; those with a watermark only for the batch window."""
    for table in wanted:
        lacking = quality.missing_columns(source[table], schemas.source_schema(table))
        if lacking:
            raise quality.DataQualityError(f"{table} lacks {', '.join(lacking)}")

    def land(table: str) -> Landed:
        df, began = window_of(source[table], table, batch_date, full, look_back), time.monotonic()
        path = landing_path(root, table, batch_date)
        rows = write_landing(stamp_extract(df, table, batch_date, batch_ts), path)
        log.info("landed %s: %d rows", table, rows)
        return Landed(rows, extract_id(table, batch_date, batch_ts), time.monotonic() - began)

    return dict(zip(wanted, at_once(*[partial(land, t) for t in wanted], limit=4), strict=True))


def run_batch(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    batch_date: dt.date,
    batch_ts: dt.datetime,
    full: bool = False,
    tables: Collection[str] | None = None,
    dry_run: bool = False,
    mode: str = "current",
    open_first: bool = False,
    max_unresolved: float | None = None,
    reject_rules: Sequence[tuple[str, Column]] = (),
    look_back: int = 0,
    normalize_nulls: bool = False,
    before_rename: Callable[[str, str], None] | None = None,
    history_cut: int = HISTORY_BUCKETS,
) -> BatchResult:
    """Run one batch into the warehouse under ``root``.

    ``full`` reads whole source tables (the first load), otherwise the tables
    with a watermark are read for the day before ``batch_date`` and
    ``look_back`` days before it; rows without a readable date are read every
    time. ``tables`` limits the batch to some source tables; dimensions left out
    are used as stored. ``dry_run`` stops after the checks. ``reject_rules``,
    pairs of a reason and a condition, send more rows to quarantine.
    ``normalize_nulls`` puts sentinels for nulls in the descriptive columns of
    products and customers. ``history_cut`` is the number of buckets by key that
    a new product or customer history is stored in: of a stored one a batch reads
    and writes the buckets of its own keys alone.

    Everything is written beside the tables and checked there; a failed critical
    check raises before any table has changed. The calendar grows with the days
    loaded. Any sequence of batches over the same source rows gives the same
    tables as one full load, but for load stamps and keys.
    """
    batch_id = batch_name(batch_date, batch_ts)
    with batch_folder(spark, batch_id):
        return _run(
            spark, source, root, batch_id, batch_date, batch_ts, full,
            tables, dry_run, mode, open_first, max_unresolved, reject_rules, look_back, normalize_nulls, before_rename, history_cut,
        )


def _run(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    batch_id: str,
    batch_date: dt.date,
    batch_ts: dt.datetime,
    full: bool,
    tables: Collection[str] | None,
    dry_run: bool,
    mode: str,
    open_first: bool,
    max_unresolved: float | None,
    reject_rules: Sequence[tuple[str, Column]],
    look_back: int,
    normalize_nulls: bool,
    before_rename: Callable[[str, str], None] | None,
    history_cut: int,
) -> BatchResult:
    house = Warehouse(spark, root)
    house.recover()
    run = house.next_run()
    staging = f"{house.root}/_staging/{batch_id}"
    delete_path(spark, staging)
    wanted = [t for t in schemas.SOURCE_DDL if tables is None or t in tables]
    landed = extract_all(source, wanted, house.root, batch_date, batch_ts, full, look_back)

    def raw(table: str) -> DataFrame:
        path = landing_path(house.root, table, batch_date)
        return read_landing(spark, path, source[table].schema)

    def inspect(table: str, mapping: ColumnMapping, model: str) -> None:
        """Warn of values that do not convert or fit; the fact rejects such rows itself."""
        warn(table, quality.source_checks(raw(table), mapping, model, quality.WARNING))

    def warn(table: str, checks: DataFrame) -> None:
        report = quality.Report.collect(table, batch_id, checks)
        for c in report.checks:
            if not c["passed"]:
                log.warning("%s %s: %s", table, c["name"], c["message"])
        reports.append(report)

    reports: list[quality.Report] = []
    made: dict[str, DataFrame] = {}
    stored: dict[str, StoredHistory] = {}
    read: dict[str, Landed] = {}

    def known(table: str) -> DataFrame:
        df = made.get(table)
        df = house.table(table) if df is None else df
        if df is None:
            raise ValueError(f"{table} is neither part of this batch nor loaded yet")
        return df

    def keep(name: str, source_table: str, built: DataFrame) -> None:
        checks = quality.schema_checks(built, schemas.target_schema(name))
        made[name], report = at_once(lambda: stage(built, name), lambda: quality.Report.collect(name, batch_id, checks))
        read[name] = landed[source_table]
        report.raise_for_failures()

    def plain(name: str) -> None:
        spec = BY_NAME[name]
        if spec.source in wanted:
            parent = known(spec.parent) if spec.parent else None
            stored = house.table(name)

            def look() -> None:
                inspect(spec.source, spec.mapping, name)
                if spec.parent == "dim_region":  # a code held by two countries leaves a city's region open
                    warn(spec.parent, quality.unique_check(parent, [spec.parent_code], quality.WARNING))

            at_once(look, lambda: keep(name, spec.source, build_dimension(spec, raw(spec.source), batch_ts, parent, stored)))

    yesterday = batch_date - dt.timedelta(days=1)

    def history(name: str, staged: DataFrame, key: str, tracked: list[str], sk: str) -> None:
        existing, highest = house.table(name), 0
        buckets = history_buckets(spark, house.path(name))
        if buckets:  # only those of this batch's keys are read and written; a table without buckets is written as a whole
            staged = stage(staged, f"{name}-delta")
            stored[name] = stored_history(spark, house.path(name), name, key, sk, staged, buckets, yesterday)
            existing, highest = stored[name].open, stored[name].highest
        built = scd2_build(existing, staged, name, [key], tracked, sk, batch_date, batch_ts, highest)
        keep(name, name.upper(), built)

    def geography_and_customers() -> None:
        for name in ("dim_continent", "dim_country", "dim_region", "dim_city"):
            plain(name)
        if "DIM_CUSTOMER" in wanted:
            staged = stage_customers(raw("DIM_CUSTOMER"), known("dim_city"))
            if normalize_nulls:
                staged = null_normalize(staged, ["customer_name", "customer_type", "segment", "kyc_status"])
            at_once(
                lambda: inspect("DIM_CUSTOMER", schemas.CUSTOMER_MAP, "dim_customer"),
                lambda: history("dim_customer", staged, "customer_bk", CUSTOMER_TRACKED, "customer_sk"),
            )

    def products() -> None:
        for name in ("dim_product_line", "dim_product_family"):
            plain(name)
        if "DIM_PRODUCT" in wanted:
            staged = stage_products(raw("DIM_PRODUCT"), known("dim_product_family"))
            if normalize_nulls:
                staged = null_normalize(staged, ["product_name", "isin_code", "currency_code"])
            at_once(
                lambda: inspect("DIM_PRODUCT", schemas.PRODUCT_MAP, "dim_product"),
                lambda: history("dim_product", staged, "product_bk", PRODUCT_TRACKED, "product_sk"),
            )

    def transactions_at_source() -> DataFrame | None:
        """What the fact has to add up to, and the warnings of the transactions: both wait for no dimension."""
        if "FACT_TXN" not in wanted:
            return None
        read_there = window_of(source["FACT_TXN"], "FACT_TXN", batch_date, full, look_back)
        expected, _ = at_once(
            lambda: stage(source_totals(read_there), "source-totals"),
            lambda: inspect("FACT_TXN", schemas.TRANSACTION_MAP, "fact_transactions"),
        )
        return expected

    _, _, expected = at_once(geography_and_customers, products, transactions_at_source)
    reports.sort(key=lambda r: r.table == "FACT_TXN")  # the transactions last, whichever ended first

    report = None
    flagged = None
    calendar = house.table("dim_time")
    window = None if full else batch_window(batch_date, look_back)
    if "FACT_TXN" in wanted:
        first, last = (window[0], window[1] - dt.timedelta(days=1)) if window else (None, None)
        if mode == "asof" and full:
            day = parse_date(F.col("TXN_DT").cast("string"))
            first, last = raw("FACT_TXN").agg(F.min(day), F.max(day)).first()

        def versions(name: str) -> DataFrame:
            """Versions for the fact: what this batch wrote and what is stored beside it, history where days matter."""
            if name not in stored:
                return known(name)
            stays = stored[name].stays
            if mode != "asof":
                stays = stays.filter(F.col("valid_to").isNull())
            return stays.unionByName(made[name])

        fact = transform_fact(
            raw("FACT_TXN"), versions("dim_customer"), versions("dim_product"),
            batch_id, batch_ts, mode, open_first, first, last,
        )
        reason = "NO_VERSION" if mode == "asof" else "UNRESOLVED_FK"
        beyond = ~F.col("txn_date").between(*CALENDAR_LIMITS)
        flagged = stage(flag_rejects(fact, [("NO_CALENDAR_DAY", beyond), *reject_rules], reason), "fact")
        grown = covering_calendar(spark, calendar, valid_rows(flagged))
        if grown is not None:
            calendar = made["dim_time"] = grown
        suite = quality.fact_suite(
            flagged,
            is_valid(),
            versions("dim_customer"),
            versions("dim_product"),
            calendar,
            expected,
            quality.MAX_UNRESOLVED if max_unresolved is None else max_unresolved,
            # Rows without a readable date are read again every night: they say nothing of this one.
            F.col("txn_date").isNotNull() if window else None,
        )
        report = quality.Report.collect("fact_transactions", batch_id, suite)
        log.info(report.summary())
        report.raise_for_failures()

    if calendar is None:
        made["dim_time"] = dim_time(spark)

    loads: list[LoadResult] = []
    seconds: dict[str, float] = {}
    outdated = 0
    if not dry_run:

        def write(name: str) -> LoadResult:
            began, index = time.monotonic(), LOOKUP_COLUMNS.get(name, [])
            target = f"{staging}/{name}"
            if name in HISTORIES:
                cut, key = stored.get(name), HISTORIES[name]
                done = load_history(
                    made[name], target, name, key, batch_id, batch_ts, index, cut.buckets if cut else history_cut
                )
                stage_top_key(made[name], key.replace("_bk", "_sk"), cut.highest if cut else 0, target)
            else:
                done = load_dimension(made[name], target, name, batch_id, batch_ts, index=index)
            seconds[name] = time.monotonic() - began
            return done

        def write_fact() -> StagedFact | None:
            if flagged is None:
                return None
            began = time.monotonic()
            staged = stage_fact(
                flagged, house.path("fact_transactions"), house.path("quarantine_fact_transactions"),
                staging, run, batch_date, window,
            )
            verify_staged(spark, staged, run, batch_id).raise_for_failures()
            seconds["fact_transactions"] = time.monotonic() - began
            return staged

        staged, *done = at_once(write_fact, *[partial(write, name) for name in made])
        loads += done
        if staged is not None:
            outdated = staged.outdated
            loads.append(LoadResult("fact_transactions", staged.loaded, staged.refused, batch_id))
            read["fact_transactions"] = landed["FACT_TXN"]

        moves: list[Move] = []
        for name in made:
            home = house.path(name)
            moves += history_moves(spark, f"{staging}/{name}", home) if name in stored else whole(f"{staging}/{name}", home)
            moves += top_key_moves(f"{staging}/{name}", home) if name in HISTORIES else []
        if staged is not None:
            moves += fact_moves(spark, staged, house.path("fact_transactions"), house.path("quarantine_fact_transactions"))

    rows = []
    for r in sorted(loads, key=lambda r: r.table):
        got = read.get(r.table, Landed(r.rows_loaded, "", 0.0))
        rows.append((
            run, batch_id, r.table, got.rows, r.rows_loaded, r.rows_rejected,
            outdated if r.table == "fact_transactions" else 0, got.extract_id, got.seconds + seconds[r.table],
        ))
    audit = spark.createDataFrame(rows, schemas.target_schema("batch_audit"))
    if rows:
        audit.withColumn("batch_date", F.lit(batch_date)).coalesce(1).write.partitionBy("batch_date").parquet(f"{staging}/batch_audit")
        # All is written and checked; from here on files are only renamed, the audit's last, and a stop is made good by recover().
        moves += added_files(spark, f"{staging}/batch_audit", house.path("batch_audit"))
        publish(spark, house.root, moves, before_rename)
    delete_path(spark, staging)
    return BatchResult(batch_id, loads, report, audit, reports)


def covering_calendar(spark: SparkSession, stored: DataFrame | None, rows: DataFrame) -> DataFrame | None:
    """The calendar with whole years for all days of ``rows``, the usual range at least; ``None`` if the stored one covers them."""
    first, last = FIRST_DAY, LAST_DAY
    if stored is not None:
        first, last = stored.agg(F.min("full_date"), F.max("full_date")).first()
    ends = rows.agg(F.min("txn_date"), F.max("txn_date")).first()
    if stored is not None and (ends[0] is None or first <= ends[0] and ends[1] <= last):
        return None
    first = min(first, dt.date(ends[0].year, 1, 1)) if ends[0] else first
    last = max(last, dt.date(ends[1].year, 12, 31)) if ends[1] else last
    return stage(dim_time(spark, first, last), "dim_time")


def verify_staged(spark: SparkSession, staged: StagedFact, run: int, batch_id: str) -> quality.Report:
    """Compare the batch with what is written of it, before it is published.

    Also that no load key stands twice in the folders written: those of other
    folders were made in earlier runs.
    """
    fact = spark.read.schema(schemas.target_schema("fact_transactions")).parquet(staged.fact)
    own = fact.filter(run_of(F.col("transaction_sk")) == run).select("net_amount")
    records = spark.read.schema(schemas.target_schema("quarantine_fact_transactions")).parquet(staged.quarantine)
    amount = F.get_json_object("raw_data", "$.net_amount").try_cast("decimal(18,4)")
    written = quality.totals(own.unionByName(records.select(amount.alias("net_amount"))), "net_amount")
    kept = (0, Decimal(0))
    if staged.kept is not None:  # records of other batches in the same folders
        kept = quality.totals(staged.kept.select(amount.alias("net_amount")), "net_amount").first()
    expected = spark.createDataFrame(
        [(staged.loaded + staged.refused + kept[0], staged.amount + kept[1])], "row_count long, amount_total decimal(38,4)"
    )
    checks = quality.reconcile_totals(expected, written, "fact_transactions", "net_amount")
    checks = checks.unionByName(quality.unique_check(fact, ["transaction_sk"]))
    return quality.Report.collect("fact_transactions", batch_id, checks)
