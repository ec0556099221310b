import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granary.operators.quality import DataQualityError
from granary.plans import marts
from granary.plans.batch import Warehouse, run_batch, source_totals
from helpers import DAY, TS, dicts, plan, small_source, source, txn

NEXT, NEXT_TS = dt.date(2024, 1, 3), dt.datetime(2024, 1, 3, 3, 0, 0)


def contents(spark, root):
    """The model's tables, without the keys of the fact, which each load makes anew."""
    tables = Warehouse(spark, root).tables()
    skip = ("dim_time", "batch_audit")
    return {t: dicts(df.drop("transaction_sk")) for t, df in tables.items() if t not in skip}


def audit(result):
    return {r.table_name: (r.rows_read, r.rows_loaded, r.rows_rejected) for r in result.audit.collect()}


def test_first_batch_loads_everything(spark, folder):
    result = run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    assert result.report.passed
    assert audit(result)["fact_transactions"] == (4, 4, 0)
    assert audit(result)["dim_time"] == (7305, 7305, 0)
    tables = Warehouse(spark, folder).tables()
    fact = tables["fact_transactions"]
    assert dicts(fact, "transaction_bk", "time_sk", "amount_eur") == [
        ("T1", 20240101, D("100.0000")),
        ("T2", 20240101, D("216.0000")),
        ("T3", 20240101, D("100.0000")),
        ("T4", 20231231, D("100.0000")),
    ]
    revenue = marts.monthly_revenue(tables)
    assert dicts(revenue, "country_name", "product_line_name", "revenue_eur") == [
        ("France", "Equities", D("100.0000")),
        ("Japan", "Equities", D("200.0000")),
    ]
    ranked = dicts(marts.top_clients(tables), "customer_bk", "volume_rank")
    assert ranked == [("CU1", 2), ("CU2", 1)]


def test_source_totals_are_those_of_the_newest_versions_without_a_division(spark):
    rows = [("A", "20240101", "5"), ("A", "2024-01-02", "-3"), ("B", None, "7"), ("B", "soon", "9"), ("C", "20240101", None), ("C", "20240101", "-4"),
            (None, "20240101", "1"), (None, None, "2"), ("D", "99991231", "-99999999999999.9999"), ("E", "20240105", None), ("E", "20240101", "3")]
    raw = spark.createDataFrame([(k, d, a and D(a)) for k, d, a in rows], "TXN_ID string, TXN_DT string, NET_AMT decimal(18,4)")
    totals = source_totals(raw)
    assert tuple(totals.first()) == (7, D("-3") + 9 - 4 + 1 + 2 - D("99999999999999.9999"))
    assert "pmod" not in plan(totals)


def test_nothing_staged_is_left_behind(spark, folder):
    from granary.session import scratch_path

    home = os.path.dirname(scratch_path(spark, "x"))
    before = set(os.listdir(home)) if os.path.isdir(home) else set()
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    assert set(os.listdir(home)) == before


def test_running_again_changes_nothing(spark, folder):
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    first = contents(spark, folder)
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    assert contents(spark, folder) == first


def test_nightly_batch(spark, folder):
    """One day later: a changed and a new customer, one day of transactions, twice."""
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    day = dt.date(2024, 1, 2)
    changed = small_source(spark) | {
        "DIM_CUSTOMER": source(
            spark,
            "DIM_CUSTOMER",
            [
                ("CU1", "Ann", "RETAIL", 11, "GOLD", "REVOKED", day),
                ("CU2", "Not in the window", "CORPORATE", 12, "SILVER", None, dt.date(2023, 1, 1)),
                ("CU3", "Cy", "RETAIL", 12, "GOLD", "PENDING", day),
            ],
        ),
        "FACT_TXN": source(
            spark,
            "FACT_TXN",
            [txn("T1"), txn("T5", day="20240102"), txn("T6", day="2024-01-02", cust="CU3")]
            + [txn("T7", day="20240102", cust="NOBODY")],
        ),
    }
    seen = []
    for _ in range(2):
        result = run_batch(spark, changed, folder, NEXT, NEXT_TS, max_unresolved=0.5)
        assert audit(result)["fact_transactions"] == (3, 2, 1)
        seen.append(contents(spark, folder))
    assert seen[0] == seen[1]
    house = Warehouse(spark, folder)
    customers = house.table("dim_customer")
    closed = customers.filter("not is_current")
    assert dicts(closed, "customer_bk", "kyc_status", "valid_from", "valid_to") == [
        ("CU1", "APPROVED", DAY, dt.date(2024, 1, 2))
    ]
    current = dicts(customers.filter("is_current"), "customer_bk", "kyc_status", "valid_from")
    assert current == [("CU1", "REVOKED", NEXT), ("CU2", None, DAY), ("CU3", "PENDING", NEXT)]
    assert customers.select("customer_sk").distinct().count() == 4
    assert dicts(house.table("fact_transactions"), "transaction_bk") == [
        (k,) for k in ("T1", "T2", "T3", "T4", "T5", "T6")
    ]
    held = house.table("quarantine_fact_transactions")
    assert dicts(held, "transaction_bk", "quarantine_reason") == [("T7", "UNRESOLVED_FK")]
    monitor = dicts(marts.batch_monitor(house.tables()), "batch_id", "rows_loaded")
    assert monitor == [("batch_20240102_030000", 4), ("batch_20240103_030000", 2)]


def test_asof_uses_the_version_of_the_day(spark, folder):
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True, mode="asof", open_first=True)
    changed = small_source(spark) | {
        "DIM_CUSTOMER": source(
            spark,
            "DIM_CUSTOMER",
            [("CU1", "Ann", "RETAIL", 11, "GOLD", "REVOKED", dt.date(2024, 1, 2))],
        ),
        "FACT_TXN": source(spark, "FACT_TXN", [txn("T5", day="20240102")]),
    }
    run_batch(spark, changed, folder, NEXT, NEXT_TS, mode="asof")
    house = Warehouse(spark, folder)
    used = house.table("fact_transactions").filter("transaction_bk = 'T5'").first().customer_sk
    version = house.table("dim_customer").filter(f"customer_sk = {used}").first()
    assert (version.kyc_status, version.is_current) == ("APPROVED", False)


def test_critical_failure_stops_before_loading(spark, folder):
    bad = small_source(spark) | {
        "FACT_TXN": source(spark, "FACT_TXN", [txn("T1", NET_AMT=D("-1"))]),
    }
    with pytest.raises(DataQualityError, match="not_negative:net_amount"):
        run_batch(spark, bad, folder, DAY, TS, full=True)
    assert Warehouse(spark, folder).tables() == {}


def test_reject_rules_send_rows_to_quarantine(spark, folder):
    bad = small_source(spark) | {
        "FACT_TXN": source(spark, "FACT_TXN", [txn("T1"), txn("T2", NET_AMT=D("-1"))]),
    }
    rules = [("NEGATIVE", F.col("net_amount") < 0)]
    run_batch(spark, bad, folder, DAY, TS, full=True, reject_rules=rules)
    house = Warehouse(spark, folder)
    assert dicts(house.table("fact_transactions"), "transaction_bk") == [("T1",)]
    held = house.table("quarantine_fact_transactions")
    assert dicts(held, "transaction_bk", "quarantine_reason") == [("T2", "NEGATIVE")]


def test_source_types_may_differ(spark, folder):
    """Amounts as text and doubles, ids as decimals: converted, and refused where they do not fit."""
    given = small_source(spark)
    txns = given["FACT_TXN"].withColumns(
        {
            "NET_AMT": F.when(F.col("TXN_ID") == "T3", "n/a").otherwise(F.col("NET_AMT").cast("string")),
            "GROSS_AMT": F.col("GROSS_AMT").cast("double"),
        }
    )
    products = given["DIM_PRODUCT"].withColumn(
        "MATURITY_DT", F.when(F.col("PRODUCT_ID") == "PR1", "never").otherwise(F.col("MATURITY_DT"))
    )
    cities = given["LKP_CITY"].withColumn("CITY_ID", F.col("CITY_ID").cast("decimal(38,0)"))
    changed = given | {"FACT_TXN": txns, "DIM_PRODUCT": products, "LKP_CITY": cities}
    result = run_batch(spark, changed, folder, DAY, TS, full=True)
    house = Warehouse(spark, folder)
    assert dicts(house.table("fact_transactions"), "transaction_bk") == [("T1",), ("T2",), ("T4",)]
    held = house.table("quarantine_fact_transactions")
    assert dicts(held, "transaction_bk", "quarantine_reason") == [
        ("T3", "MISSING:net_amount,BAD_VALUE:net_amount")
    ]
    assert '"bad_raw":["NET_AMT=n/a"]' in held.first().raw_data
    failed = [(r.table, c["name"]) for r in result.source_reports for c in r.checks if not c["passed"]]
    assert failed == [("DIM_PRODUCT", "type:MATURITY_DT"), ("FACT_TXN", "type:NET_AMT")]


def test_missing_source_column_stops_the_batch(spark, folder):
    bad = small_source(spark)
    bad["LKP_CITY"] = bad["LKP_CITY"].drop("LAT", "LNG")
    with pytest.raises(DataQualityError, match="LKP_CITY lacks LAT, LNG"):
        run_batch(spark, bad, folder, DAY, TS, full=True)


def test_too_many_unresolved_keys_stop_the_batch(spark, folder):
    bad = small_source(spark) | {
        "FACT_TXN": source(spark, "FACT_TXN", [txn("T1"), txn("T2", cust="NOBODY")]),
    }
    with pytest.raises(DataQualityError, match="referential_integrity:customer_sk"):
        run_batch(spark, bad, folder, DAY, TS, full=True)


def test_dry_run_checks_and_loads_nothing(spark, folder):
    result = run_batch(spark, small_source(spark), folder, DAY, TS, full=True, dry_run=True)
    assert result.report.passed and result.loads == [] and result.audit.count() == 0
    assert Warehouse(spark, folder).tables() == {}


def test_some_tables_only(spark, folder):
    with pytest.raises(ValueError, match="dim_product_line"):
        run_batch(spark, small_source(spark), folder, DAY, TS, full=True, tables=["LKP_PROD_FAM"])
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    result = run_batch(spark, small_source(spark), folder, NEXT, NEXT_TS, full=True, tables=["LKP_PROD_FAM"])
    assert audit(result) == {"dim_product_family": (2, 2, 0)}


def test_source_totals(spark):
    rows = [txn("A", NET_AMT=D("1")), txn("A", day="20240102", NET_AMT=D("2"))]
    rows += [txn(None, NET_AMT=D("5")), txn(None, NET_AMT=D("6"))]
    assert tuple(source_totals(source(spark, "FACT_TXN", rows)).first()) == (3, D("13.0000"))
    assert tuple(source_totals(source(spark, "FACT_TXN", [])).first()) == (0, D("0.0000"))


def test_views(spark, folder):
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    marts.create_views(spark, Warehouse(spark, folder).tables())
    total = spark.sql(
        "SELECT country_name, sum(revenue_eur) AS s FROM V_MONTHLY_REVENUE_BY_COUNTRY"
        " WHERE year = 2024 GROUP BY 1 ORDER BY 1"
    )
    assert [tuple(r) for r in total.collect()] == [("France", D("100")), ("Japan", D("200"))]
    assert spark.sql("SELECT total_rows, nb_batches FROM V_PIPELINE_QUALITY_KPI").first() == (4, 1)
    assert spark.table("V_TOP_CLIENTS").count() == 2 and spark.table("V_CHANNEL_ANALYSIS").count() == 3
    # A row added later shows in the views as they are, ranks included.
    tables = Warehouse(spark, folder).tables()
    seen = dicts(spark.table("V_TOP_CLIENTS"), "customer_bk", "total_volume_eur", "volume_rank")
    assert seen == [("CU1", D("100.0000"), 2), ("CU2", D("200.0000"), 1)]
    more = tables["fact_transactions"].filter("transaction_bk = 'T1'").withColumn("net_amount", F.lit(D("150")).cast("decimal(18,4)"))
    more.write.mode("append").partitionBy("time_sk").parquet(Warehouse(spark, folder).path("fact_transactions"))
    marts.refresh_views(spark, tables)
    seen = dicts(spark.table("V_TOP_CLIENTS"), "customer_bk", "total_volume_eur", "volume_rank")
    assert seen == [("CU1", D("250.0000"), 1), ("CU2", D("200.0000"), 2)]
    steps = plan(spark.table("V_TOP_CLIENTS")).splitlines()
    above = [steps[i - 1] for i, step in enumerate(steps) if "Exchange SinglePartition" in step]
    assert above and all("Aggregate" in step for step in above)  # sums and quantiles, no sort


LATER, LATER_TS = dt.date(2024, 1, 4), dt.datetime(2024, 1, 4, 3, 0, 0)


def facts_of(spark, root):
    house = Warehouse(spark, root)
    fact = house.table("fact_transactions")
    assert fact.select("transaction_sk").distinct().count() == fact.count()
    held = house.table("quarantine_fact_transactions")
    return dicts(fact, "transaction_bk", "time_sk", "net_amount"), dicts(held, "transaction_bk", "quarantine_reason")


def test_any_sequence_of_batches_equals_one_full_load(spark, folder):
    """Bad dates, restated rows, rows refused and then good, one day read twice, and a late posting."""
    def given(*rows):
        return small_source(spark) | {"FACT_TXN": source(spark, "FACT_TXN", list(rows))}

    first = [txn("T1"), txn("T2", day="20231231"), txn("T3", cust="NOBODY"), txn("B1", day="02/01/2024"), txn(None, day=None)]
    second = [*first, txn("T1", day="20240102", NET_AMT=D("90")), txn("T3", day="20240102"), txn("T4", day="20240102", cust="NO"), txn("B2", day=" 20240102x")]
    last = [*second, txn("T4", day="20240103"), txn("T2", day="20240103", cust="NO"), txn("T6", day="20231231")]
    options = {"max_unresolved": 0.9}
    steps = f"{folder}/steps"
    run_batch(spark, given(*first), steps, DAY, TS, full=True, **options)
    run_batch(spark, given(*first), steps, DAY, TS, **options)  # the same day again, as a nightly run
    assert facts_of(spark, steps)[1] == [
        ("B1", "MISSING:time_sk,BAD_VALUE:txn_date"), ("T3", "UNRESOLVED_FK"), (None, "MISSING:transaction_bk,MISSING:time_sk")
    ]
    run_batch(spark, given(*second), steps, NEXT, NEXT_TS, **options)
    run_batch(spark, given(*last), steps, LATER, LATER_TS, look_back=3, **options)
    run_batch(spark, given(*last), steps, NEXT, NEXT_TS, **options)  # an older day once more
    run_batch(spark, given(*last), f"{folder}/whole", LATER, LATER_TS, full=True, **options)
    assert facts_of(spark, steps) == facts_of(spark, f"{folder}/whole")
    fact, held = facts_of(spark, steps)
    assert fact == [
        ("T1", 20240102, D("90.0000")), ("T3", 20240102, D("100.0000")), ("T4", 20240103, D("100.0000")), ("T6", 20231231, D("100.0000"))
    ]
    assert [k for k, _ in held] == ["B1", "B2", "T2", None]
    runs = Warehouse(spark, steps).table("batch_audit").filter("table_name = 'fact_transactions'")
    assert dicts(runs, "run") == [(k,) for k in range(1, 6)]
    run_batch(spark, given(*last), steps, LATER, LATER_TS, full=True, **options)
    assert facts_of(spark, steps) == (fact, held)  # a reload leaves no record of older runs


def test_calendar_grows(spark, folder):
    rows = [txn("A", day="20090305"), txn("B", day="20310101"), txn("C", day="99990101")]
    given = small_source(spark) | {"FACT_TXN": source(spark, "FACT_TXN", rows)}
    run_batch(spark, given, folder, DAY, TS, full=True, max_unresolved=0.5, mode="asof", open_first=True)
    house = Warehouse(spark, folder)
    ends = house.table("dim_time").agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(ends) == (dt.date(2009, 1, 1), dt.date(2031, 12, 31))
    fact, held = facts_of(spark, folder)
    assert [k for k, *_ in fact] == ["A", "B"] and [k for k, _ in held] == ["C"] and "NO_CALENDAR_DAY" in held[0][1]


def test_nothing_is_published_when_a_write_fails(spark, folder, monkeypatch):
    from granary.plans import batch

    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    before = contents(spark, folder)
    for name in ("load_history", "load_dimension", "stage_fact", "verify_staged"):
        with monkeypatch.context() as patch:
            def fail(*_, **__):
                raise OSError("no disk")

            patch.setattr(batch, name, fail)
            with pytest.raises(OSError, match="no disk"):
                run_batch(spark, small_source(spark), folder, NEXT, NEXT_TS, full=True)
        assert contents(spark, folder) == before


def test_sentinels_on_request(spark, folder):
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True, normalize_nulls=True)
    assert Warehouse(spark, folder).table("dim_customer").filter("kyc_status is null").count() == 0
