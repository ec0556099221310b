import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.calendar import dim_time, holiday_rows
from granary.functions.clean import (
    align,
    convert,
    date_key,
    minutes_crossed,
    null_normalize,
    parse_date,
    project,
    project_checked,
    with_key,
)
from helpers import dicts, source, txn


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("20240229", dt.date(2024, 2, 29)),
        ("2024-02-29", dt.date(2024, 2, 29)),
        ("20230229", None),
        ("2024-0229", None),
        ("2024022", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_dates_in_text(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_date(F.col("t"))).first()[0] == day


def test_dates_are_read_as_the_patterns_read_them(spark):
    """Also years of other lengths and signs, white space and line ends."""
    texts = ["20240229", "2024-02-29", "20230229", "+120140613", "-00010101", "00000101", "+12014-06-13", "20140613\n",
             " 20140613", "2014-6-13", "2014-06-13T00:00:00", "201406131", "15/06/2014", "2014.06.15", "-", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.coalesce(F.try_to_date("t", "yyyyMMdd"), F.try_to_date("t", "yyyy-MM-dd"))
    got = df.select("t", parse_date(F.col("t")).cast("string").alias("a"), slow.cast("string").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a is not None for r in got) == 6


def test_text_that_is_no_date_does_not_reach_the_pattern(spark):
    """Under this setting a text stops the query that the pattern's parser refuses and the one before Spark 3 reads."""
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "EXCEPTION")
    try:
        df = spark.createDataFrame([("2014-06-13 and more",), ("20140613 ",), ("20140613",)], "t string")
        assert [str(r[0]) for r in df.select(parse_date(F.col("t"))).collect()] == ["None", "None", "2014-06-13"]
    finally:
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")


def test_date_key_and_minutes(spark):
    df = spark.sql(
        "select date'2024-01-01' d, timestamp_ntz'2024-01-01 00:00:59' a,"
        " timestamp_ntz'2024-01-01 00:02:00' b"
    )
    row = df.select(date_key(F.col("d")), minutes_crossed(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (20240101, 2)


def test_convert_gives_null_for_what_does_not_fit(spark):
    df = spark.createDataFrame([("12.34567",), ("x",), ("99999999999999999",)], "v string")
    got = [r[0] for r in df.select(convert(F.col("v"), "decimal(18,4)")).collect()]
    assert got == [D("12.3457"), None, None]


def test_project_renames_casts_and_titles(spark):
    raw = source(spark, "LKP_CONTINENT", [("EU", "EUROPE"), (None, "nowhere"), ("NA", "north america")])
    out = with_key(project(raw, schemas.CONTINENT_MAP), ["continent_code"])
    assert dicts(out) == [("EU", "Europe"), ("NA", "North America")]


def test_bad_values_are_named(spark):
    raw = source(spark, "FACT_TXN", [txn("A"), txn("B", day="20241301"), txn("C", day=None)])
    out = project_checked(raw, schemas.TRANSACTION_MAP)
    assert dicts(out, "transaction_bk", "bad_values", "bad_raw") == [
        ("A", [], []),
        ("B", ["BAD_VALUE:txn_date"], ["TXN_DT=20241301"]),
        ("C", [], []),
    ]


def test_bad_values_of_text_columns(spark):
    raw = source(spark, "FACT_TXN", [txn("A")]).withColumn("NET_AMT", F.lit("oops"))
    row = project_checked(raw, schemas.TRANSACTION_MAP).first()
    assert row.bad_values == ["BAD_VALUE:net_amount"] and row.net_amount is None


def test_null_normalize(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d decimal(18,4), t date")
    assert tuple(null_normalize(df).first()) == ("UNKNOWN", -1, D("-1.0000"), None)
    assert tuple(null_normalize(df, ["i"]).first()) == (None, -1, None, None)


def test_align_fills_and_orders(spark):
    df = spark.createDataFrame([(1, "EU")], "continent_sk int, continent_code string")
    out = align(df, schemas.target_schema("dim_continent"))
    assert out.columns == schemas.target_schema("dim_continent").names
    assert out.first().continent_name is None


def test_calendar(spark):
    cal = dim_time(spark).cache()
    assert cal.count() == 7305
    assert [f.name for f in cal.schema] == schemas.target_schema("dim_time").names
    row = cal.filter("time_sk = 20240501").first()
    assert (row.day_of_week, row.day_name, row.month_name, row.quarter) == (3, "Wed", "May", 2)
    assert row.is_public_holiday and not row.is_weekend
    assert cal.filter("is_public_holiday").count() == 11
    assert cal.filter("time_sk = 20240107").first().is_weekend
    cal.unpersist()


def test_calendar_takes_other_holidays(spark):
    cal = dim_time(spark, dt.date(2025, 1, 1), dt.date(2025, 1, 3), holiday_rows(spark, ["2025-01-02"] * 2))
    assert dicts(cal, "time_sk", "is_public_holiday") == [
        (20250101, False),
        (20250102, True),
        (20250103, False),
    ]
