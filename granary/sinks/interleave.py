"""Order by several columns at once, so that a filter on any one of them skips files and row groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_interleaved_ranks(df: DataFrame, columns: Sequence[str], name: str, bits: int = 6) -> DataFrame:
    """Add ``name``: the bits of the ranks of numeric ``columns``, taken in turn, the highest first.

    The rank of a value is the number of quantiles, of ``2 ** bits - 1``, that it
    is not below, so that a column of any spread is cut into parts of about the
    same number of rows; a value that many rows share takes several quantiles,
    and its rows get one rank. Nulls rank lowest. Quantiles are found by one
    aggregate, and only they come to the driver.
    """
    parts = 2**bits
    cuts = [k / parts for k in range(1, parts)]
    found = df.agg(*[F.percentile_approx(c, cuts) for c in columns]).first()
    edges = [F.lit([str(e) for e in q]).cast(f"array<{df.schema[c].dataType.simpleString()}>") if q else None for c, q in zip(columns, found, strict=True)]
    ranks = [f"{name}_{i}" for i in range(len(columns))]
    out = df.withColumns({r: F.lit(0) for r in ranks})
    for bit in reversed(range(bits)):  # a binary search, one projection a step
        out = out.withColumns({
            r: F.col(r) + F.when(F.col(c) >= F.element_at(e, F.col(r) + 2**bit), F.lit(2**bit)).otherwise(0)
            for r, c, e in zip(ranks, columns, edges, strict=True) if e is not None
        })
    width = len(columns)

    def placed(bit: int, i: int) -> Column:
        return F.shiftleft(F.shiftright(F.col(ranks[i]), bit).bitwiseAND(F.lit(1)).cast("long"), bit * width + width - 1 - i)

    every = [placed(bit, i) for bit in range(bits) for i in range(width)]
    return out.withColumn(name, reduce(lambda a, b: a + b, every)).drop(*ranks)
