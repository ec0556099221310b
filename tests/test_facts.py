import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.operators import facts
from helpers import TS, dicts, source, target, txn


def dims(spark):
    customers = target(
        spark,
        "dim_customer",
        [
            {"customer_bk": "CU1", "customer_sk": 1, "city_sk": 10, "is_current": True,
             "valid_from": dt.date(2024, 1, 3)},
            {"customer_bk": "CU1", "customer_sk": 5, "city_sk": 11, "is_current": False,
             "valid_from": dt.date(2020, 1, 1), "valid_to": dt.date(2024, 1, 2)},
            {"customer_bk": "CU2", "customer_sk": 2, "city_sk": 20, "is_current": True,
             "valid_from": dt.date(2024, 1, 1)},
        ],
    )
    products = target(
        spark,
        "dim_product",
        [{"product_bk": "PR1", "product_sk": 1, "is_current": True, "valid_from": dt.date(2000, 1, 1)}],
    )
    return customers, products


def fact(spark, *rows, **options):
    return facts.transform_fact(source(spark, "FACT_TXN", rows), *dims(spark), "b1", TS, **options)


def test_keys_dates_and_euro(spark):
    row = fact(spark, txn("T1", NET_AMT=D("200"), FX_RATE_EUR=D("1.08"))).first()
    assert (row.time_sk, row.customer_sk, row.city_sk, row.product_sk) == (20240101, 1, 10, 1)
    assert row.amount_eur == D("216.0000")
    assert (row.source_system, row.batch_id, row.loaded_at) == ("ORACLE_ERP", "b1", TS)


def test_columns_are_those_of_the_table(spark):
    names = schemas.target_schema("fact_transactions").names[1:]
    assert fact(spark, txn("T1")).columns[: len(names)] == names


@pytest.mark.parametrize(
    ("net", "rate", "eur"),
    [("0.0001", "0.5", "0.0001"), ("-0.0001", "0.5", "-0.0001"), ("1.0005", "0.333333", "0.3335")],
)
def test_euro_rounds_half_up(spark, net, rate, eur):
    assert fact(spark, txn("T", NET_AMT=D(net), FX_RATE_EUR=D(rate))).first().amount_eur == D(eur)


def test_newest_version_stays(spark):
    out = fact(spark, txn("T1", status="PENDING"), txn("T1", day="20240102"), txn("T2"))
    assert dicts(out, "transaction_bk", "time_sk", "transaction_status") == [
        ("T1", 20240102, "SETTLED"),
        ("T2", 20240101, "SETTLED"),
    ]


def test_both_date_spellings_compare(spark):
    assert fact(spark, txn("T1", day="2024-01-05"), txn("T1", day="20240104")).first().time_sk == 20240105


def test_current_and_asof(spark):
    rows = [txn("T1", day="20240102"), txn("T2", day="20240103"), txn("T3", "20191231")]
    assert dicts(fact(spark, *rows), "transaction_bk", "customer_sk") == [("T1", 1), ("T2", 1), ("T3", 1)]
    asof = [("T1", 5), ("T2", 1), ("T3", None)]
    assert dicts(fact(spark, *rows, mode="asof"), "transaction_bk", "customer_sk") == asof
    opened = fact(spark, *rows, mode="asof", open_first=True)
    assert dicts(opened, "transaction_bk", "customer_sk") == [("T1", 5), ("T2", 1), ("T3", 5)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        fact(spark, txn("T1"), mode="other")


def test_each_row_goes_one_way(spark):
    rows = [
        txn("OK"),
        txn("NOCUST", cust="NOBODY"),
        txn("NULLCUST", cust=None),
        txn("NOPROD", prod="NOTHING"),
        txn("BADDAY", day="20241399"),
        txn(None),
        txn(None, NET_AMT=D("5")),
        txn("NONET", NET_AMT=None),
        txn("HUGE", NET_AMT=D("99999999999999"), GROSS_AMT=D("99999999999999"), FX_RATE_EUR=D("2")),
    ]
    flagged = facts.flag_rejects(fact(spark, *rows)).cache()
    assert dicts(facts.valid_rows(flagged), "transaction_bk") == [("OK",)]
    assert dicts(facts.rejected_rows(flagged), "transaction_bk", "reasons") == sorted(
        [
            ("BADDAY", ["MISSING:time_sk", "BAD_VALUE:txn_date"]),
            ("HUGE", ["BAD_VALUE:amount_eur"]),
            ("NOCUST", ["UNRESOLVED_FK"]),
            ("NONET", ["MISSING:net_amount"]),
            ("NOPROD", ["UNRESOLVED_FK"]),
            ("NULLCUST", ["UNRESOLVED_FK"]),
            (None, ["MISSING:transaction_bk"]),
            (None, ["MISSING:transaction_bk"]),
        ],
        key=repr,
    )
    flagged.unpersist()


def test_own_rules_add_reasons(spark):
    rules = [("NEGATIVE", F.col("net_amount") < 0)]
    flagged = facts.flag_rejects(fact(spark, txn("A", NET_AMT=D("-1")), txn("B", NET_AMT=None)), rules)
    assert dicts(flagged, "transaction_bk", "reasons") == [("A", ["NEGATIVE"]), ("B", ["MISSING:net_amount"])]


def test_quarantine_record_holds_the_whole_row(spark):
    rejected = facts.rejected_rows(facts.flag_rejects(fact(spark, txn("Q", cust="NOBODY"))))
    record = facts.quarantine_records(rejected).first()
    assert (record.transaction_bk, record.quarantine_reason, record.batch_id) == ("Q", "UNRESOLVED_FK", "b1")
    raw = json.loads(record.raw_data)
    assert raw["customer_bk"] == "NOBODY" and raw["customer_sk"] is None and raw["net_amount"] == 100


def test_hot_customer_survives_a_shuffled_join(spark):
    """A customer with most rows, no broadcast: the join is split and the result whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    raw = spark.range(6000).select(
        F.concat(F.lit("T"), "id").alias("TXN_ID"),
        F.lit("20240101").alias("TXN_DT"),
        F.when(F.col("id") % 3 > 0, "CU1").otherwise(F.concat(F.lit("X"), "id")).alias("CUST_ID"),
        F.lit("PR1").alias("PROD_ID"),
        *[F.lit(v).alias(n) for n, v in (("TXN_TYPE_CD", "BUY"), ("STATUS_CD", "SETTLED"), ("CHANNEL_CD", "API"))],
        *[F.lit(1).cast("decimal(18,4)").alias(n) for n in ("GROSS_AMT", "NET_AMT", "FEE_AMT", "TAX_AMT")],
        *[F.lit(1).cast("decimal(18,6)").alias(n) for n in ("QTY", "UNIT_PRICE")],
        F.lit("EUR").alias("CURRENCY_CD"),
        F.lit(1).cast("decimal(10,6)").alias("FX_RATE_EUR"),
    )
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = facts.transform_fact(raw.repartition(8), *dims(spark), "b", TS)
        found = out.groupBy(F.col("customer_sk").isNotNull().alias("found")).count()
        assert dicts(found) == [(False, 2000), (True, 4000)]
        ran = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in ran
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
