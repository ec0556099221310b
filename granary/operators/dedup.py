"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(names: Sequence[str]) -> list[Column]:
    return [
        F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_first()
        for n in names
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key under ``order_by``, ties broken on all other columns.

    A name in ``order_by`` with a leading ``-`` sorts descending, nulls last.
    Spark cuts each map task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows arrives as one
    row per map task. Rows without a key are no copies of each other: only
    those equal in every column count as one.
    """
    named = {n.removeprefix("-") for n in order_by}
    rest = [c for c in df.columns if c not in named and c not in keys]
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    whole_row = F.when(keyless, F.struct(*df.columns))
    one = Window.partitionBy(*keys, "_whole").orderBy(*_order([*order_by, *rest]))
    return (
        df.withColumn("_whole", whole_row)
        .withColumn("_nr", F.row_number().over(one))
        .filter(F.col("_nr") == 1)
        .drop("_nr", "_whole")
    )


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest in the order of the remaining columns."""
    return latest_per_key(df, keys, [])
