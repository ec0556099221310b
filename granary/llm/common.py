"""Shared helpers: held-out rows, labelled samples, text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import stage


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Let Spark hand texts to Python in batches of at most so many rows and bytes: a row may be a whole book.

    This stays set in the caller's session, since plans are run after they were made; results don't depend on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def in_bucket(id_col: str, modulus: int, remainder: int) -> Column:
    """True where the id falls into the held-out remainder; false for a null id."""
    return F.coalesce(bucket(id_col, modulus) == remainder, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` is called so; Spark's names know no case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def as_bytes(column: str) -> Column:
    """UTF-8 bytes of a text column, so that words split at ASCII white space only."""
    return F.col(column).cast("binary")


def about(df: DataFrame, limit: int, *key: str) -> DataFrame:
    """About ``limit`` rows, and hardly ever more, chosen by a hash of ``key``; all if there are no more.

    A hash below a bound is tested row by row: nothing is sorted or brought together.
    """
    share = 0.95 * limit / max(1, df.count())
    return df if share >= 0.95 else df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 32)) < int(share * (1 << 32)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, limit: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """About ``limit`` labelled training documents as (id, label, text), chosen by a hash of the id.

    Ids in the held-out remainder, null ids and null labels are left out; of
    several labels of one id the largest counts. The chosen ids are rows of 12
    bytes; ``limit`` of them bound the broadcast. The result is staged, so that
    texts are read once.
    """
    small_batches(docs.sparkSession)
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~in_bucket("id", modulus, remainder))
              .groupBy("id").agg(F.max("label").alias("label")))
    chosen = about(chosen, limit, "id").limit(limit)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stage(rows.join(F.broadcast(chosen), "id").select("id", "label", "text"), "labelled")
