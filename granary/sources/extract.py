"""Reading source tables: partitioned JDBC scans and the batch window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.clean import parse_date

# Rows per round trip, parallel reads of a lookup and of the fact.
FETCH_SIZE = 50_000
PARTITIONS = 20
FACT_PARTITIONS = 40
BUCKET_COLUMN = "ROWID_HASH"


def batch_window(batch_date: dt.date, look_back: int = 0) -> tuple[dt.date, dt.date]:
    """The day before ``batch_date`` and ``look_back`` days before that, as a half-open window."""
    return batch_date - dt.timedelta(days=1 + look_back), batch_date


def in_window(df: DataFrame, column: str, batch_date: dt.date, look_back: int = 0, undated: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies in the window of the batch.

    The column is a date, a timestamp, or a date held as text. Plain comparisons
    are pushed down to the source; for text they keep a superset in either
    spelling, which the parsed date then cuts to the exact rows.

    ``undated`` keeps rows without a readable date, too. They lie in no window,
    so each batch has to see them; for text no comparison finds them, and the
    whole table is read.
    """
    lo, hi = batch_window(batch_date, look_back)
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, T.StringType):
        within = (c >= F.lit(lo)) & (c < F.lit(hi))
        return df.filter(within | c.isNull()) if undated else df.filter(within)

    def spelled(pattern: str) -> Column:
        return (c >= lo.strftime(pattern)) & (c < hi.strftime(pattern))

    day = parse_date(c)
    if undated:  # one expression, so that each text is read once
        return df.filter(F.coalesce(F.floor(F.date_diff(day, F.lit(lo)) / (hi - lo).days) == 0, F.lit(True)))
    within = (day >= F.lit(lo)) & (day < F.lit(hi))
    return df.filter(spelled("%Y%m%d") | spelled("%Y-%m-%d")).filter(within)


def partition_bounds(df: DataFrame, column: str, default: tuple[int, int]) -> DataFrame:
    """One row: least and greatest value of a split column, ``default`` for an empty table."""
    return df.agg(
        F.coalesce(F.min(column), F.lit(default[0])).cast("long").alias("lower_bound"),
        F.coalesce(F.max(column), F.lit(default[1])).cast("long").alias("upper_bound"),
    )


def split_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """Conditions that cut a table into ``parts`` reads, each row in exactly one.

    For ``spark.read.jdbc(..., predicates=...)`` where the split column is not a
    plain number. The first part takes the nulls too; the outer ones are open,
    so rows written since the bounds were asked for are not lost.
    """
    if parts < 2:
        return ["1 = 1"]
    cuts = [lower + (upper + 1 - lower) * i // parts for i in range(1, parts)]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [first, *inner, f"{column} >= {cuts[-1]}"]


@dataclass(frozen=True)
class Depths:
    """What is known of a split column: cuts that part its rows evenly, how often heavy values stand, nulls and all rows."""

    cuts: tuple
    heavy: dict
    nulls: int
    rows: int


def depths(df: DataFrame, column: str, parts: int, accuracy: int = 1000) -> Depths:
    """Quantiles of a split column by a mergeable sketch, and exact counts of the values that fill whole parts.

    One pass for the quantiles, of which the driver gets ``parts`` - 1, and one
    more only if some are equal. The column holds numbers, days or times; for
    text the source is asked by :func:`depths_query`. A cut is off by at most a
    share of 1 / (``accuracy`` * ``parts``) of the rows.
    """
    ranks = [i / parts for i in range(1, parts)]
    one = df.agg(
        F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("nulls"),
        (F.percentile_approx(column, ranks, accuracy * parts) if ranks else F.array()).alias("cuts"),
    ).first()
    cuts = one.cuts or []
    return _with_heavy(cuts, one.nulls, one.rows, lambda often: {
        r[0]: r[1] for r in df.filter(F.col(column).isin(often)).groupBy(column).count().collect()
    })


def _with_heavy(cuts: Sequence, nulls: int, rows: int, count: Callable[[list], dict]) -> Depths:
    often = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    return Depths(tuple(sorted(set(cuts))), count(often) if often else {}, nulls, rows)


def even_predicates(column: str, found: Depths, parts: int, spread: str | None = None) -> list[str]:
    """Conditions that cut a table into reads of about the same size, each row in exactly one.

    A value that fills a part or more gets reads of its own, and so do nulls if
    there are so many. ``spread`` is a source expression with ``{n}`` in it, that
    deals the rows of one value into buckets 0 to n - 1, for instance
    ``MOD(ORA_HASH(ROWID), {n})``; without it a heavy value is one read. The outer
    reads are open, so that rows written meanwhile are not lost.
    """
    mean = max(1.0, found.rows / parts)

    def dealt(condition: str, rows: int) -> list[str]:
        n = max(1, round(rows / mean)) if spread else 1
        return [condition] if n == 1 else [f"{condition} AND {spread.format(n=n)} = {i}" for i in range(n)]

    out, low = [], ""
    for cut in found.cuts:
        value = _literal(cut)
        between = " AND ".join(c for c in (low, f"{column} < {value}") if c)
        out.append(between)
        if cut in found.heavy:
            out += dealt(f"{column} = {value}", found.heavy[cut])
            low = f"{column} > {value}"
        else:
            low = f"{column} >= {value}"
    # Without cuts this is one read of everything that is not null.
    out.append(low or f"{column} IS NOT NULL")
    if found.nulls >= mean:
        return out + dealt(f"{column} IS NULL", found.nulls)
    return [f"({out[0]}) OR {column} IS NULL", *out[1:]]


def _literal(value: object) -> str:
    """A value as source SQL: text and days in quotes, numbers as they are."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, dt.date) else str(value)


def depths_query(query: str, column: str, parts: int) -> str:
    """Least value, greatest value and rows of each of ``parts`` even parts of a split column, found by the source; part 0 has the nulls."""
    return (
        f"SELECT part, MIN({column}) AS low, MAX({column}) AS high, COUNT(*) AS part_rows FROM ("
        f"SELECT {column}, CASE WHEN {column} IS NULL THEN 0 ELSE NTILE({parts}) OVER (ORDER BY {column}) END AS part FROM ({query}) q) p GROUP BY part"
    )


def depths_of(found: Sequence[tuple]) -> Depths:
    """The rows of :func:`depths_query` as :func:`depths` gives them.

    A value that begins several parts is heavy; its rows are those of the parts
    that it fills, and at most one part's more.
    """
    ordered = sorted(r for r in found if r[0])
    cuts = [r[1] for r in ordered[1:]]
    nulls = sum(r[3] for r in found if not r[0])
    return _with_heavy(cuts, nulls, sum(r[3] for r in found), lambda often: {v: sum(r[3] for r in ordered if r[1] <= v <= r[2]) for v in often})


def split_sizes(df: DataFrame, predicates: list[str]) -> DataFrame:
    """Rows each split would read, all counted in one pass."""
    sizes = df.agg(*[F.count_if(F.expr(p)).alias(f"s{i}") for i, p in enumerate(predicates)])
    pairs = [
        F.struct(F.lit(i).alias("split"), F.col(f"s{i}").alias("rows_in_split"))
        for i in range(len(predicates))
    ]
    return sizes.select(F.inline(F.array(*pairs)))


def net_total(df: DataFrame, amount: str, watermark: str, batch_date: dt.date) -> DataFrame:
    """Sum of ``amount`` at the source over the same window the extract reads."""
    return in_window(df, watermark, batch_date).agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,4)").alias("net_total")
    )


def row_hash(partitions: int) -> str:
    """Source expression with values 0 .. ``partitions`` - 1, spread evenly over the rows."""
    return f"ORA_HASH(ROWID, {partitions - 1})"


def window_condition(watermark: str, batch_date: dt.date, text_dates: bool = False) -> str:
    """The batch window as a condition the source evaluates.

    ``text_dates`` compares against ``yyyyMMdd`` text instead of a date.
    """
    lo, hi = batch_window(batch_date)
    spell = "'{0:%Y%m%d}'" if text_dates else "DATE '{0}'"
    return f"t.{watermark} >= {spell.format(lo)} AND t.{watermark} < {spell.format(hi)}"


def extract_query(
    table: str,
    partitions: int = PARTITIONS,
    watermark: str | None = None,
    batch_date: dt.date | None = None,
    text_dates: bool = False,
    bucket: str | None = None,
) -> str:
    """The query the source runs: whole table, or the batch window of ``watermark``.

    ``bucket`` is the source's expression for the split column, by default
    :func:`row_hash`.
    """
    bucket = bucket or row_hash(partitions)
    query = f"SELECT t.*, {bucket} AS {BUCKET_COLUMN} FROM {table} t"
    if watermark is None:
        return query
    return f"{query} WHERE {window_condition(watermark, batch_date, text_dates)}"


def bounds_query(query: str, column: str, default: tuple[int, int]) -> str:
    """Least and greatest value of ``column``, found by the source."""
    return (
        f"SELECT COALESCE(MIN({column}), {default[0]}) AS lower_bound,"
        f" COALESCE(MAX({column}), {default[1]}) AS upper_bound FROM ({query}) q"
    )


def net_total_query(
    table: str, amount: str, watermark: str, batch_date: dt.date, text_dates: bool = False
) -> str:
    """Sum of ``amount`` over the batch window, computed by the source."""
    condition = window_condition(watermark, batch_date, text_dates)
    return f"SELECT COALESCE(SUM(t.{amount}), 0) AS net_total FROM {table} t WHERE {condition}"


def jdbc_options(
    connection: Mapping[str, str],
    query: str,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = PARTITIONS,
    custom_schema: str | None = None,
) -> dict[str, str]:
    """Reader options for one query; with ``column`` it is read in ``partitions`` parts.

    Types are overridden by ``custom_schema``, since a reader schema that
    differs from the table is refused.
    """
    options = {**connection, "dbtable": f"({query}) src", "fetchsize": str(FETCH_SIZE)}
    if custom_schema:
        options["customSchema"] = custom_schema
    if column is not None:
        lower, upper = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            # Spark cuts equal strides below the upper bound, which it excludes.
            "upperBound": str(upper + 1),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    partitions: int = PARTITIONS,
    column: str = BUCKET_COLUMN,
    watermark: str | None = None,
    batch_date: dt.date | None = None,
    text_dates: bool = False,
    custom_schema: str | None = None,
    bucket: str | None = None,
    even: bool = False,
    spread: str | None = None,
) -> DataFrame:
    """A source table as a frame read over ``partitions`` connections.

    A hash bucket has known bounds; for any other split column the source is
    asked for them, and one row comes back. With ``even`` it is asked for the
    column's quantiles instead, and each connection reads about as many rows; a
    heavy value is dealt out by ``spread``, see :func:`even_predicates`.
    """
    query = extract_query(table, partitions, watermark, batch_date, text_dates, bucket)
    if even:
        asked = jdbc_options(connection, depths_query(query, column, partitions))
        found = depths_of([tuple(r) for r in spark.read.format("jdbc").options(**asked).load().collect()])
        options = jdbc_options(connection, query, custom_schema=custom_schema)
        place, what = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(place, what, predicates=even_predicates(column, found, partitions, spread), properties=options)
    bounds = (0, partitions - 1)
    if column != BUCKET_COLUMN:
        asked = jdbc_options(connection, bounds_query(query, column, bounds))
        row = spark.read.format("jdbc").options(**asked).load().first()
        bounds = (int(row[0]), int(row[1]))
    options = jdbc_options(connection, query, column, bounds, partitions, custom_schema)
    return spark.read.format("jdbc").options(**options).load()
