"""Rank over a whole table without bringing it to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def _rank_top(counts: DataFrame, value: str, name: str, k: int) -> DataFrame:
    above = Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.orderBy(F.col(value).desc())
        .limit(k)
        .select(value, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(name))
        .filter(F.col(name) <= k)
    )


def _rank_all(counts: DataFrame, value: str, name: str, buckets: int) -> DataFrame:
    """Rank of each distinct value, as a plan: nothing is computed here.

    Quantiles cut the values into ranges. They travel in one row together with
    the rows in each range, so what is ranked inside a range is shifted by the
    rows above that very range, even if quantiles come out otherwise when the
    plan runs again.
    """
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    none = F.array().cast(ArrayType(counts.schema[value].dataType))
    edges = counts.agg(F.coalesce(F.array_distinct(F.percentile_approx(value, cuts)), none).alias("_edges"))

    def placed(cut: DataFrame) -> DataFrame:
        # Nulls compare with nothing; they rank last, as in a descending sort.
        place = F.size(F.filter("_edges", lambda e: e > F.col(value)))
        return counts.join(F.broadcast(cut)).withColumn("_bucket", F.when(F.col(value).isNull(), F.lit(buckets)).otherwise(place))

    sizes = placed(edges).groupBy("_edges", "_bucket").agg(F.sum("_n").alias("_size"))
    ranges = sizes.groupBy("_edges").agg(F.collect_list(F.struct("_bucket", "_size")).alias("_sizes"))  # at most a row a bucket
    above = (
        Window.partitionBy("_bucket")
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.aggregate(
        F.filter("_sizes", lambda s: s["_bucket"] < F.col("_bucket")), F.lit(0).cast("long"), lambda n, s: n + s["_size"]
    )
    return placed(ranges).select(
        value, "_bucket", before.alias("_before"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above")
    ).select(value, (F.col("_before") + F.col("_above") + 1).alias(name))


def global_rank(
    df: DataFrame, value: str, name: str, top: int | None = None, buckets: int = 64
) -> DataFrame:
    """Add the ``RANK()`` of each row by ``value`` descending; ``top`` keeps ranks up to it.

    The ranked thing is the distinct value with its number of rows: a value
    shared by many rows is one row here. For ``top`` the best k values are
    enough. For the whole table the values are cut at their quantiles, ranked
    inside each range, and shifted by the rows in the ranges above. The result is
    a plan, in which ``df`` stands more than once: stage it first, unless the
    plan is to be kept as a view. ``value`` has to come out the same each time,
    as exact numbers do.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    if top is not None:
        ranks = F.broadcast(_rank_top(counts, value, name, top))
    else:
        ranks = _rank_all(counts, value, name, buckets)
    ranks = ranks.withColumnRenamed(value, "_value")
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"])).drop("_value")
