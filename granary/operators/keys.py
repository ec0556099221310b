"""Surrogate keys: assigning them and looking them up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import stage



def hash_bucket(columns: Sequence[str], buckets: int) -> Column:
    """Bucket 0 .. ``buckets`` - 1 of a row, the same in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def bucket_histogram(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """Rows per hash bucket."""
    return df.groupBy(hash_bucket(columns, buckets).alias("bucket")).agg(
        F.count("*").alias("rows_in_bucket")
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], sk: str, start: Column | int = 0, buckets: int = 1024, staged: bool = False
) -> DataFrame:
    """Add ``sk`` = start + 1, start + 2, ... without a global sort.

    ``keys`` are unique, so hashing spreads the rows evenly. They are numbered
    inside each bucket, and each bucket starts where the ones before it end.
    Only the bucket sizes, ``buckets`` rows, meet in one place. Sizes and rows
    are read one after the other, so ``df`` is written first, unless it is
    ``staged``: a source that changes in between can't make keys repeat.
    """
    bucketed = (df if staged else stage(df, "to-number")).withColumn("_bucket", hash_bucket(keys, buckets))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        bucketed.withColumn("_nr", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(sk, (start + F.col("_offset") + F.col("_nr")).cast("long"))
        .drop("_bucket", "_nr", "_offset")
    )


def same_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality on every pair of columns; still a plain equi-join for Spark."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def assign_surrogate_keys(
    df: DataFrame,
    keys: Sequence[str],
    sk: str,
    existing: DataFrame | None = None,
    carry: Sequence[str] = (),
    buckets: int = 1024,
) -> DataFrame:
    """Give every row of ``df`` its surrogate key.

    ``df`` has one row per natural key. Keys known to ``existing`` keep theirs
    (and its ``carry`` columns); the others are numbered on from the highest.
    """
    if existing is None:
        return number_rows(df, keys, sk, buckets=buckets).withColumns(
            {c: F.lit(None).cast("timestamp_ntz") for c in carry}
        )
    pairs = [(k, f"_known_{k}") for k in keys]
    known = existing.select(*[F.col(k).alias(a) for k, a in pairs], sk, *carry)
    matched = stage(df.join(known, same_key(df, known, pairs), "left").drop(*[a for _, a in pairs]), "matched")
    highest = F.coalesce(existing.agg(F.max(sk)).scalar(), F.lit(0))
    fresh = matched.filter(F.col(sk).isNull()).drop(sk)
    return matched.filter(F.col(sk).isNotNull()).unionByName(
        number_rows(fresh, keys, sk, highest, buckets, staged=True)
    )


def fill_surrogate_keys(
    df: DataFrame, keys: Sequence[str], sk: str, buckets: int = 1024, highest: int = 0
) -> DataFrame:
    """Number the rows of a staged frame whose ``sk`` is null, on from its highest key.

    A frame that is a part of a table comes with the ``highest`` key of the table.
    """
    highest = F.greatest(df.agg(F.max(sk)).scalar(), F.lit(highest))
    fresh = df.filter(F.col(sk).isNull()).drop(sk)
    kept = df.filter(F.col(sk).isNotNull())
    return kept.unionByName(number_rows(fresh, keys, sk, highest, buckets, staged=True))


def load_key(run: int) -> Column:
    """A unique key per written row of a fact batch, without a shuffle.

    From the top: number of the run (14 bits), number of the written partition
    (21), place in it (28). Every run has a number of its own, also one for a day
    loaded before, so keys never repeat; they grow with the runs and have gaps. A
    batch too large for them fails rather than repeat one.
    """
    if not 0 <= run < 2**14:
        raise ValueError(f"run {run} has no keys left")
    part = F.spark_partition_id().cast("long")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    key = F.lit(run * 2**49).cast("long") + part * 2**28 + place
    fits = (part < 2**21) & (place < 2**28)
    return F.when(fits, key).otherwise(F.raise_error(F.lit("more rows or partitions than load keys")))


def run_of(key: Column) -> Column:
    """The run a load key was made in."""
    return F.shiftright(key, 49)


def lookup_surrogate_key(
    df: DataFrame, dim: DataFrame, on: str, sk: str, unique: bool = True
) -> DataFrame:
    """Add ``sk`` of the row of ``dim`` with the same ``on``; null where there is none.

    With ``unique=False`` the lowest key of a repeated code is taken, so that
    rows of ``df`` are never multiplied.
    """
    side = dim.select(on, sk) if unique else dim.groupBy(on).agg(F.min(sk).alias(sk))
    return df.join(side, on, "left")
