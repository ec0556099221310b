"""Dimensions that keep history: one row per version, one current row per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.calendar import FIRST_DAY, LAST_DAY
from granary.functions.clean import align, project, stamp, with_key
from granary.operators.dedup import dedup_by_key
from granary.operators.keys import fill_surrogate_keys, lookup_surrogate_key, number_rows
from granary.session import stage

# The columns whose change makes a new version.
CUSTOMER_TRACKED = ["customer_name", "kyc_status"]
PRODUCT_TRACKED = ["product_name", "isin_code", "is_active"]


def stage_customers(raw: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Typed customers, one per key, with the key of their city."""
    rows = dedup_by_key(with_key(project(raw, schemas.CUSTOMER_MAP), ["customer_bk"]), ["customer_bk"])
    return lookup_surrogate_key(rows, dim_city, "city_id", "city_sk").drop("city_id")


def stage_products(raw: DataFrame, dim_product_family: DataFrame) -> DataFrame:
    """Typed products, one per key, with the key of their family."""
    rows = dedup_by_key(with_key(project(raw, schemas.PRODUCT_MAP), ["product_bk"]), ["product_bk"])
    return lookup_surrogate_key(
        rows, dim_product_family, "product_family_code", "product_family_sk"
    ).drop("product_family_code")


def current_rows(dim: DataFrame) -> DataFrame:
    """Current versions. They have no closing day, so a table kept by it skips its history."""
    rows = dim.filter("is_current")
    return rows.filter("valid_to is null") if "valid_to" in dim.columns else rows


def _differs(old: str, new: str, tracked: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in tracked],
    )


def changed_keys(
    existing: DataFrame, staged: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Keys whose current row differs from the staged one, changes from and to null included."""
    old = current_rows(existing).alias("old")
    new = staged.alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    return old.join(new, on).filter(_differs("old", "new", tracked)).select(
        *[F.col(f"old.{k}") for k in keys]
    )


def new_keys(existing: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without a current row."""
    return staged.join(current_rows(existing).select(*keys), list(keys), "left_anti")


def scd2_apply(
    existing: DataFrame,
    staged: DataFrame,
    table: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    sk: str,
    batch_date: dt.date,
    batch_ts: dt.datetime,
) -> DataFrame:
    """The whole dimension after this extract; new versions have no surrogate key yet.

    History passes through untouched, and so do current rows without a staged
    one. The others meet the staged rows by key, which is unique on both sides.
    Staged rows are written first: a small delta is broadcast by its real size,
    and the dimension is then only read, not shuffled. Each pair yields its rows:

    * no staged row, no tracked change, or a current row from a later day: as is
    * no current row: a first version
    * a version opened this very day: replaced in place, so a rerun is harmless
    * any other change: the old row closed the day before, and a new version
    """
    schema = schemas.target_schema(table)
    existing = align(existing, schema)
    is_current = F.coalesce("is_current", F.lit(False))
    day, now = F.lit(batch_date), stamp(batch_ts)

    staged = stage(staged, f"{table}-delta")
    current = existing.filter(is_current)
    old = current.select(*keys, F.struct(*schema.names).alias("old"))
    new = staged.select(*keys, F.struct(*staged.columns).alias("new"))
    pairs = stage(old.join(new, list(keys)), f"{table}-pairs")
    fresh = new.join(pairs.select(*keys), list(keys), "left_anti").withColumn("old", F.lit(None).cast(pairs.schema["old"].dataType))
    untouched = current.join(staged.select(*keys), list(keys), "left_anti")

    def version(source: str, **changes: Column) -> Column:
        """A row of the dimension, taken from ``source`` but for ``changes``."""
        have = schema.names if source == "old" else staged.columns
        fields = []
        for f in schema.fields:
            value = changes.get(f.name)
            if value is None:
                value = F.col(f"{source}.{f.name}") if f.name in have else F.lit(None)
            fields.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*fields)

    opened = {"valid_from": day, "is_current": F.lit(True), "updated_at": now}
    first = version("new", **opened, created_at=now)
    in_place = version(
        "new", **opened, **{sk: F.col(f"old.{sk}")}, created_at=F.col("old.created_at")
    )
    closed = version(
        "old", valid_to=F.date_sub(day, 1), is_current=F.lit(False), updated_at=now
    )
    kept = version("old")
    rows = (
        F.when(F.col("old").isNull(), F.array(first))
        .when(~_differs("old", "new", tracked) | (F.col("old.valid_from") > day), F.array(kept))
        .when(F.col("old.valid_from") == day, F.array(in_place))
        .otherwise(F.array(closed, first))
    )
    changed = pairs.unionByName(fresh).select(F.inline(rows))
    return existing.filter(~is_current).unionByName(untouched.select(*schema.names)).unionByName(changed)


def scd2_initial(
    staged: DataFrame, table: str, batch_date: dt.date, batch_ts: dt.datetime
) -> DataFrame:
    """First load: every staged row is a current version."""
    now = stamp(batch_ts)
    opened = {
        "valid_from": F.lit(batch_date),
        "is_current": F.lit(True),
        "created_at": now,
        "updated_at": now,
    }
    return align(staged.withColumns(opened), schemas.target_schema(table))


def scd2_build(
    existing: DataFrame | None,
    staged: DataFrame,
    table: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    sk: str,
    batch_date: dt.date,
    batch_ts: dt.datetime,
    highest: int = 0,
) -> DataFrame:
    """The dimension after this extract, every version with its surrogate key.

    ``existing`` may be a part of the stored dimension that holds all current
    versions of the staged keys; ``highest`` is then the highest key of all of it.
    """
    names = schemas.target_schema(table).names
    version = [*keys, "valid_from"]
    if existing is None:
        rows = scd2_initial(staged, table, batch_date, batch_ts).drop(sk)
        return number_rows(rows, version, sk).select(*names)
    rows = scd2_apply(existing, staged, table, keys, tracked, sk, batch_date, batch_ts)
    return fill_surrogate_keys(stage(rows, table), version, sk, highest=highest).select(*names)


def asof_lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    open_first: bool = False,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Add ``take`` of the version of ``key`` valid on ``day``; null where there is none.

    Versions are laid out per year of their validity, cut to ``first`` ..
    ``last``, so key and year join by equality. A key with a long history is
    then compared within one year only, and a key with many rows is spread over
    the years. A version without a closing day is open without end. A batch
    passes its own date range; where none is given the first and last day of
    ``df`` are asked for. With ``open_first`` a key's first version also covers
    the time before it.
    """
    if first is None or last is None:
        ends = df.agg(F.min(day), F.max(day)).first()
        first, last = first or ends[0] or FIRST_DAY, last or ends[1] or LAST_DAY
    start = F.col("valid_from")
    if open_first:
        begins = F.min("valid_from").over(Window.partitionBy(key))
        start = F.when(start == begins, F.lit(first)).otherwise(start)
    versions = (
        dim.select(
            key,
            *take,
            start.alias("_from"),
            F.coalesce("valid_to", F.lit(last)).alias("_to"),
        )
        .filter((F.col("_from") <= F.lit(last)) & (F.col("_to") >= F.lit(first)))
        .withColumns(
            {
                "_from": F.greatest("_from", F.lit(first)),
                "_to": F.least("_to", F.lit(last)),
            }
        )
        .filter(F.col("_from") <= F.col("_to"))
        .withColumn("_year", F.explode(F.sequence(F.year("_from"), F.year("_to"))))
        .withColumnRenamed(key, "_key")
    )
    at = F.col(day)
    valid = (
        (F.col(key) == F.col("_key"))
        & (F.year(at) == F.col("_year"))
        & (at >= F.col("_from"))
        & (at <= F.col("_to"))
    )
    return df.join(versions, valid, "left").drop("_key", "_year", "_from", "_to")
