import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.operators import quality as q
from helpers import plan, source, txn


def only(checks):
    rows = checks.collect()
    assert len(rows) == 1
    return rows[0]


def test_not_null(spark):
    df = spark.createDataFrame([("A",), (None,)], "k string")
    row = only(q.row_checks(df, [q.not_null("k")]))
    assert (row.name, row.severity, row.passed) == ("not_null:k", "CRITICAL", False)
    assert (row.failed_rows, row.total_rows, row.pass_rate) == (1, 2, 0.5)
    assert row.message == "1 of 2 rows fail (rate 0.500000, allowed 0.000000)"


def test_not_null_within_tolerance(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    assert only(q.row_checks(df, [q.not_null("k", max_null_rate=0.005)])).passed
    assert not only(q.row_checks(df, [q.not_null("k", max_null_rate=0.0005)])).passed


def test_empty_frame(spark):
    df = spark.createDataFrame([], "k string, v int")
    rows = q.row_checks(df, [q.not_null("k"), q.not_negative("v")]).collect()
    assert [(r.passed, r.failed_rows, r.total_rows, r.pass_rate) for r in rows] == [(True, 0, 0, None)] * 2
    assert only(q.unique_check(df, ["k"])).passed
    dim = spark.createDataFrame([("a",)], "k string")
    assert only(q.integrity_checks(df, [q.Reference("k", dim, "k")])).passed


@pytest.mark.parametrize(
    ("rows", "columns", "failed"),
    [
        ([("A", 1), ("A", 2), ("B", 1)], ["k"], 1),
        ([("A", 1), ("A", 2), ("B", 1)], ["k", "m"], 0),
        ([("A", 1), ("A", 1), ("A", 1)], ["k", "m"], 2),
        ([(None, 1), (None, 1), ("A", 1)], ["k"], 1),
    ],
)
def test_unique(spark, rows, columns, failed):
    row = only(q.unique_check(spark.createDataFrame(rows, "k string, m int"), columns))
    assert (row.name, row.failed_rows, row.passed) == (f"unique:{'+'.join(columns)}", failed, failed == 0)


def test_accepted_values_let_nulls_pass(spark):
    df = spark.createDataFrame([("BUY",), ("SELL",), ("HACK",), (None,)], "t string")
    row = only(q.row_checks(df, [q.accepted_values("t", schemas.TRANSACTION_TYPES)]))
    assert (row.failed_rows, row.severity) == (1, "WARNING")


def test_not_negative_and_gross(spark):
    df = spark.createDataFrame(
        [(D("100"), D("110")), (D("0"), D("0")), (D("-5"), D("-6")), (None, D("1"))],
        "net_amount decimal(18,4), gross_amount decimal(18,4)",
    )
    rows = q.row_checks(df, [q.not_negative("net_amount"), q.gross_gte_net()]).collect()
    assert [r.failed_rows for r in rows] == [1, 1]
    assert rows[1].name == "business_rule:gross_gte_net"


def test_all_row_rules_share_one_scan(spark, folder):
    spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    text = plan(q.row_checks(df, [q.not_null("a"), q.not_negative("b"), q.not_null("b")]))
    assert text.count("FileScan") == 1


def test_integrity(spark):
    fact = spark.createDataFrame([(1, 7), (1, 8), (None, 7), (3, 7)], "c long, t int")
    customers = spark.createDataFrame([(1,), (2,)], "customer_sk long")
    days = spark.createDataFrame([(7,), (7,), (8,)], "time_sk int")
    refs = [
        q.Reference("c", customers, "customer_sk", max_rate=0.5),
        q.Reference("t", days, "time_sk"),
    ]
    rows = {r.name: r for r in q.integrity_checks(fact, refs).collect()}
    assert rows["referential_integrity:c→customer_sk"].failed_rows == 2
    assert rows["referential_integrity:c→customer_sk"].passed
    assert rows["referential_integrity:t→time_sk"].failed_rows == 0
    assert {r.total_rows for r in rows.values()} == {4}


def one_row(spark, count, amount):
    return spark.createDataFrame([(count, D(amount))], "row_count long, amount_total decimal(38,4)")


@pytest.mark.parametrize(
    ("source_side", "target_side", "rows_pass", "amount_pass"),
    [
        ((1_000_000, "5000000"), (1_000_000, "5000000"), True, True),
        ((1_000_000, "5000000"), (997_000, "4999750"), True, True),
        ((1_000_000, "5000000"), (990_000, "4940000"), False, False),
        ((0, "0"), (0, "0"), True, True),
        ((0, "0"), (1, "1"), False, False),
        ((10, "-100"), (10, "-100.05"), True, True),
        ((10, "-100"), (10, "100"), True, False),
    ],
)
def test_reconcile(spark, source_side, target_side, rows_pass, amount_pass):
    checks = q.reconcile_totals(one_row(spark, *source_side), one_row(spark, *target_side), "t", "net")
    rows = {r.name: r.passed for r in checks.collect()}
    assert rows == {"reconciliation:row_count:t": rows_pass, "reconciliation:amount:net:t": amount_pass}


def test_reconcile_frames(spark):
    a = spark.createDataFrame([(D("1.5"),), (D("2.5"),)], "x decimal(18,4)")
    b = spark.createDataFrame([(D("4.0"),)], "y decimal(18,4)")
    rows = {r.name: r.passed for r in q.reconcile(a, b, "t", "x", "y").collect()}
    assert rows == {"reconciliation:row_count:t": False, "reconciliation:amount:y:t": True}


def test_schema(spark):
    df = spark.createDataFrame([(1, "a")], "continent_sk int, continent_code string")
    got = {r.name: r.passed for r in q.schema_checks(df, schemas.target_schema("dim_continent")).collect()}
    assert got["column_present:continent_sk"] and not got["column_type:continent_sk"]
    assert got["column_type:continent_code"] and not got["column_present:continent_name"]


def test_source_conversion_and_length(spark):
    rows = [txn("T1"), txn("T2", day="nonsense"), txn("X" * 101)]
    checks = q.source_checks(source(spark, "FACT_TXN", rows), schemas.TRANSACTION_MAP, "fact_transactions")
    failed = {r.name: r.failed_rows for r in checks.collect() if r.failed_rows}
    assert failed == {"type:TXN_DT": 1, "max_length:TXN_ID": 1}


def test_report(spark):
    df = spark.createDataFrame([("A", -1), (None, 1)], "k string, v int")
    checks = q.row_checks(df, [q.not_null("k"), q.not_negative("v", q.WARNING), q.not_null("v", q.INFO)])
    report = q.Report.collect("t", "b1", checks)
    assert not report.passed and [c["name"] for c in report.critical_failures] == ["not_null:k"]
    assert report.summary() == "t b1: 1 of 3 checks hold, failed"
    with pytest.raises(q.DataQualityError, match="not_null:k"):
        report.raise_for_failures()
    assert tuple(q.report_frame(checks).first()) == (3, 1, 1, False)
    good = q.Report.collect("t", "b1", q.row_checks(df, [q.not_null("v")]))
    assert good.raise_for_failures().passed


def test_differing_rows_are_found_one_by_one(spark):
    day = dt.date(2024, 1, 1)
    rows = [(f"T{k}", day + dt.timedelta(days=k % 3), D(k)) for k in range(200)]
    frame = lambda r: spark.createDataFrame(r, "k string, d date, x decimal(18,4)")
    found = lambda a, b, **more: sorted((r.k, r.x, r.in_source, r.in_target) for r in q.differing_rows(frame(a), frame(b), ["k"], ["x"], "d", **more).collect())
    assert found(rows, rows[::-1]) == [] == found([], [])
    swapped = [*rows[:4], ("T4", rows[4][1], D(7)), *rows[5:7], ("T7", rows[7][1], D(4)), *rows[8:]]
    for buckets in (1, 7, 1024):
        assert found(rows, swapped, buckets=buckets) == [("T4", D(4), 1, 0), ("T4", D(7), 0, 1), ("T7", D(4), 0, 1), ("T7", D(7), 1, 0)]
    assert found(rows, [*rows, rows[3], rows[3]]) == [("T3", D(3), 1, 3)]  # a pair that a xor would cancel
    assert found(rows, rows[1:]) == [("T0", D(0), 1, 0)]
    moved = [("T0", day + dt.timedelta(days=1), D(0)), *rows[1:]]
    assert found(rows, moved) == [("T0", D(0), 0, 1), ("T0", D(0), 1, 0)]
    assert q.differing_rows(frame([(None, day, None)]), frame([(None, None, None)]), ["k"], ["x"], "d").count() == 2
    assert q.differing_rows(frame([(None, None, None)]), frame([(None, None, None)]), ["k"], ["x"], "d").count() == 0
    assert q.differing_rows(frame([("a", None, None)]), frame([(None, None, None)]), ["k"], ["x"], "d").count() == 2
