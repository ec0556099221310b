"""The time dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.clean import date_key

# Range of the calendar and the public holidays it marks.
FIRST_DAY = dt.date(2010, 1, 1)
LAST_DAY = dt.date(2029, 12, 31)
HOLIDAYS = [
    "2024-01-01",
    "2024-04-01",
    "2024-05-01",
    "2024-05-08",
    "2024-05-09",
    "2024-05-20",
    "2024-07-14",
    "2024-08-15",
    "2024-11-01",
    "2024-11-11",
    "2024-12-25",
]


def date_rows(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def holiday_rows(spark: SparkSession, days: Iterable[str]) -> DataFrame:
    listed = spark.createDataFrame([(d,) for d in days], "holiday string")
    return listed.select(F.col("holiday").cast("date").alias("holiday_date")).distinct()


def dim_time(
    spark: SparkSession,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day with its calendar parts; ``holidays`` has a column ``holiday_date``."""
    if holidays is None:
        holidays = holiday_rows(spark, HOLIDAYS)
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return (
        date_rows(spark, first, last)
        .join(holidays, d == F.col("holiday_date"), "left")
        .select(
            date_key(d).alias("time_sk"),
            d,
            iso_day.alias("day_of_week"),
            F.dayname(d).alias("day_name"),
            F.dayofmonth(d).alias("day_of_month"),
            F.dayofyear(d).alias("day_of_year"),
            F.weekofyear(d).alias("week_of_year"),
            F.month(d).alias("month_number"),
            F.monthname(d).alias("month_name"),
            F.quarter(d).alias("quarter"),
            F.year(d).alias("year"),
            (iso_day >= 6).alias("is_weekend"),
            F.col("holiday_date").isNotNull().alias("is_public_holiday"),
            F.year(d).alias("fiscal_year"),
            F.quarter(d).alias("fiscal_quarter"),
        )
    )
