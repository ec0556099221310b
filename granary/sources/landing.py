"""The landing zone: one Parquet folder per source table and logical day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.functions.clean import stamp


def extract_id(table: str, batch_date: dt.date, batch_ts: dt.datetime) -> str:
    return f"{table}_{batch_date:%Y%m%d}_{batch_ts:%H%M%S}"


def stamp_extract(
    df: DataFrame, table: str, batch_date: dt.date, batch_ts: dt.datetime
) -> DataFrame:
    """Add when, in which extract and from which table a row was read."""
    return df.withColumns(
        {
            "_extracted_at": stamp(batch_ts),
            "_batch_id": F.lit(extract_id(table, batch_date, batch_ts)),
            "_source_table": F.lit(table),
        }
    )


def landing_path(root: str, table: str, day: dt.date) -> str:
    folder = table.replace(".", "/").lower()
    return f"{root}/raw/{folder}/year={day:%Y}/month={day:%m}/day={day:%d}"


def write_landing(df: DataFrame, path: str) -> int:
    """Write one table's extract and return its rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(path)
    return seen.get["rows"]


def read_landing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The extract under an explicit schema: no file is opened to infer one."""
    return spark.read.schema(schema).parquet(path)
