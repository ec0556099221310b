"""Typed projection, date parsing and null handling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Mapping = Sequence[tuple[str, str, str]]

# What stands for a missing value when normalization is asked for.
NULL_TEXT = "UNKNOWN"
NULL_NUMBER = -1


def stamp(ts: dt.datetime) -> Column:
    """A constant timestamp, the same whatever the time zone of session or driver."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_date(col: Column) -> Column:
    """A date from ``yyyyMMdd`` or ``yyyy-MM-dd`` text; null where it is neither.

    Text of these shapes is cast, and text with other signs than digits, plus and
    minus is no date: both cost a fraction of the pattern's parser, which raises
    and catches an error for each text it can't read. That gets the rest, as
    years of other lengths.
    """
    dashed = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
    other = F.coalesce(F.try_to_date(col, "yyyyMMdd"), F.try_to_date(col, "yyyy-MM-dd"))
    return (
        F.when(col.rlike(r"^[0-9]{8}\z"), dashed.try_cast("date"))
        .when(col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), col.try_cast("date"))
        .when(F.translate(col, "0123456789+-", "") == "", other)
    )


def date_key(col: Column) -> Column:
    """The integer key ``yyyyMMdd`` of a date."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps (not whole elapsed minutes)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def convert(col: Column, kind: str) -> Column:
    """``col`` as ``kind``; null where the value does not fit."""
    if kind == "date8":
        return parse_date(col.cast("string"))
    if kind == "title":
        return F.initcap(col.cast("string"))
    return col.try_cast(kind)


def project(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Select, rename and convert the columns of ``mapping``."""
    return df.select(*[convert(F.col(s), kind).alias(t) for s, t, kind in mapping])


def where_true(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """The texts whose condition holds for a row, in order, as an array."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(c, F.array(text)).otherwise(none) for text, c in pairs])


def reasons(pairs: Iterable[tuple[str, Column]]) -> Column:
    """The names of all conditions that hold for a row, in order."""
    return where_true([(F.lit(name), c) for name, c in pairs])


def may_fail(df: DataFrame, column: str, kind: str) -> bool:
    """Whether a value of ``column`` can be present and yet not convert to ``kind``."""
    if kind in ("string", "title"):
        return False
    return kind == "date8" or df.schema[column].dataType != T.DataType.fromDDL(kind)


def project_checked(df: DataFrame, mapping: Mapping) -> DataFrame:
    """:func:`project`, and what did not convert.

    ``bad_values`` names the columns, ``bad_raw`` holds their text at the source.
    """
    risky = [(s, t) for s, t, kind in mapping if may_fail(df, s, kind)]
    converted = [convert(F.col(s), kind).alias(t) for s, t, kind in mapping]
    raw = [F.col(s).cast("string").alias(f"_raw_{t}") for s, t in risky]
    failed = {t: F.col(f"_raw_{t}").isNotNull() & F.col(t).isNull() for _, t in risky}
    text = [(F.concat(F.lit(f"{s}="), f"_raw_{t}"), failed[t]) for s, t in risky]
    return df.select(*converted, *raw).select(
        *[t for _, t, _ in mapping],
        reasons([(f"BAD_VALUE:{t}", failed[t]) for _, t in risky]).alias("bad_values"),
        where_true(text).alias("bad_raw"),
    )


def with_key(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which every column of the natural key is present."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def null_normalize(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace nulls by the sentinel of the column's type; other types stay as they are."""
    wanted = set(df.columns if columns is None else columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in wanted and isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(NULL_TEXT)).alias(f.name)
        elif f.name in wanted and isinstance(f.dataType, T.IntegralType | T.DecimalType):
            c = F.coalesce(c, F.lit(NULL_NUMBER).cast(f.dataType)).alias(f.name)
        out.append(c)
    return df.select(*out)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; absent ones are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
