"""Source rows that the queries make up from the given tables."""

import datetime as dt
import threading

from helpers import plan

from granary.operators import quality
from granary.operators.facts import type_transactions
from workload import queries


def test_transactions_sent_again_hold_the_rules_of_a_batch(spark, folder):
    """A line without discount and tax has its net equal to its gross; sent again with a higher net it must not lie above."""
    lines = [(k, k, 1, 1, 7.0, 1000.0, 0.0, tax, "A", dt.date(1998, 5, 10)) for k, tax in ((1, 0.0), (2, 0.08))]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    frame = spark.createDataFrame(lines, f"{names}, l_discount double, l_tax double, l_returnflag string, l_shipdate date")
    frame.write.parquet(f"{folder}/lineitem.parquet")
    orders = [(1, 1, "F", "1-URGENT"), (2, 1, "O", "3-MEDIUM")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    typed = type_transactions(queries._restated(spark, folder))
    assert typed.count() == 4
    (check,) = quality.row_checks(typed, [quality.gross_gte_net()]).collect()
    assert check.failed_rows == 0 and check.passed
    again = typed.filter("txn_date = date '2014-06-15'").select("transaction_bk", "net_amount", "gross_amount")
    assert [tuple(map(str, r)) for r in again.sort("transaction_bk").collect()] == [("1-1", "1001.0000", "1001.0000"), ("2-1", "1001.0000", "1081.0000")]


def test_transactions_and_those_sent_again_come_from_one_read(spark, sf_dir):
    """The transactions are a join of the two largest tables: it is made once."""
    made = plan(queries._restated(spark, sf_dir))
    assert made.count("FileScan parquet") == 2


def test_rows_are_worked_out_once_to_be_compared(spark, sf_dir):
    """Both sides, their fingerprints and their ends read the newest versions as written, not from the source again."""
    assert "l_orderkey" not in plan(queries.dq_reconcile_rows(spark, sf_dir))


def test_a_clustered_table_is_worked_out_once(spark, sf_dir, monkeypatch):
    """Ranks, boundaries and the write itself each read the whole frame."""
    seen, write = [], queries.sinks.write_clustered
    monkeypatch.setattr(queries.sinks, "write_clustered", lambda df, *args, **more: seen.append(plan(df)) or write(df, *args, **more))
    queries.clustered_product_read(spark, sf_dir)
    queries.point_lookup(spark, sf_dir)
    assert len(seen) == 2 and not any("l_orderkey" in p for p in seen)


def test_the_suite_writes_the_columns_it_reads(spark, sf_dir, monkeypatch):
    seen, write = {}, queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, name: seen.setdefault(name, df.columns) and write(df, name))
    assert queries._suite(spark, sf_dir).count() == 17
    assert seen["fact"] == quality.SUITE_COLUMNS


def test_the_suite_writes_the_fact_and_the_source_totals_side_by_side(spark, sf_dir, monkeypatch):
    """Each waits for the other to begin: one after the other would break the barrier."""
    both, write = threading.Barrier(2, timeout=30), queries.stage

    def meeting(df, name):
        if name in ("fact", "source-totals"):
            both.wait()
        return write(df, name)

    monkeypatch.setattr(queries, "stage", meeting)
    assert queries._suite(spark, sf_dir).count() == 17
