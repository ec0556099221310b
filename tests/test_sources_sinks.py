import datetime as dt
import glob
import os
from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.sinks import tables as sinks
from granary.sources import extract, landing
from helpers import DAY, TS, dicts, plan, source, target, txn


def test_full_and_incremental_query():
    full = "SELECT t.*, ORA_HASH(ROWID, 19) AS ROWID_HASH FROM ERP.X t"
    assert extract.extract_query("ERP.X") == full
    window = " WHERE t.UPD >= DATE '2024-01-01' AND t.UPD < DATE '2024-01-02'"
    assert extract.extract_query("ERP.X", watermark="UPD", batch_date=DAY) == full + window
    text = extract.extract_query("ERP.X", 40, "TXN_DT", DAY, text_dates=True)
    assert text.endswith("WHERE t.TXN_DT >= '20240101' AND t.TXN_DT < '20240102'")
    assert "ORA_HASH(ROWID, 39)" in text


def test_aggregates_run_at_the_source():
    query = extract.extract_query("ERP.X", bucket="MOD(ID, 20)")
    assert extract.bounds_query(query, "ID", (0, 19)) == (
        "SELECT COALESCE(MIN(ID), 0) AS lower_bound, COALESCE(MAX(ID), 19) AS upper_bound"
        " FROM (SELECT t.*, MOD(ID, 20) AS ROWID_HASH FROM ERP.X t) q"
    )
    assert extract.net_total_query("ERP.F", "NET", "TXN_DT", DAY, text_dates=True) == (
        "SELECT COALESCE(SUM(t.NET), 0) AS net_total FROM ERP.F t"
        " WHERE t.TXN_DT >= '20240101' AND t.TXN_DT < '20240102'"
    )


def test_jdbc_options():
    options = extract.jdbc_options(
        {"url": "jdbc:x"}, "SELECT 1", "ROWID_HASH", (0, 19), 20, "LAT decimal(10,6)"
    )
    assert options == {
        "url": "jdbc:x",
        "dbtable": "(SELECT 1) src",
        "fetchsize": "50000",
        "customSchema": "LAT decimal(10,6)",
        "partitionColumn": "ROWID_HASH",
        "lowerBound": "0",
        "upperBound": "20",
        "numPartitions": "20",
    }
    assert "partitionColumn" not in extract.jdbc_options({}, "SELECT 1")


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_splits_hold_each_row_once(spark, parts):
    df = spark.sql("select case when id > 3 then id end as id from range(50)")
    sizes = extract.split_sizes(df, extract.split_predicates("id", 5, 40, parts)).collect()
    assert len(sizes) == parts and sum(r.rows_in_split for r in sizes) == 50


def test_bounds(spark):
    assert tuple(extract.partition_bounds(spark.range(3, 9), "id", (0, 20)).first()) == (3, 8)
    assert tuple(extract.partition_bounds(spark.range(0), "id", (0, 20)).first()) == (0, 20)


def test_window_on_text_is_half_open(spark):
    days = ["20231231", "20240101", "2024-01-01", "20240102", "2024-01-02", "202401011", "x", None]
    df = source(spark, "FACT_TXN", [txn(str(i), day=d) for i, d in enumerate(days)])
    assert dicts(extract.in_window(df, "TXN_DT", DAY), "TXN_ID") == [("1",), ("2",)]


def test_window_is_pushed_down(spark, folder):
    source(spark, "FACT_TXN", [txn("a")]).write.parquet(f"{folder}/t")
    text = plan(extract.in_window(spark.read.parquet(f"{folder}/t"), "TXN_DT", DAY))
    assert "GreaterThanOrEqual(TXN_DT,20240101)" in text
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (DAY,)], "d date")
    assert extract.in_window(df, "d", DAY).count() == 1


def test_net_total(spark):
    df = source(spark, "FACT_TXN", [txn("a", NET_AMT=D("1.5")), txn("b", day="20231231")])
    assert extract.net_total(df, "NET_AMT", "TXN_DT", DAY).first()[0] == D("1.5000")
    assert extract.net_total(df, "NET_AMT", "TXN_DT", dt.date(2000, 1, 1)).first()[0] == 0


def test_landing(spark, folder):
    path = landing.landing_path(folder, "ERP.FACT_TXN", DAY)
    assert path == f"{folder}/raw/erp/fact_txn/year=2024/month=01/day=02"
    df = landing.stamp_extract(source(spark, "FACT_TXN", [txn("a"), txn("b")]), "ERP.FACT_TXN", DAY, TS)
    assert df.first()["_batch_id"] == "ERP.FACT_TXN_20240102_030000"
    for _ in range(2):
        assert landing.write_landing(df, path) == 2
    back = landing.read_landing(spark, path, schemas.source_schema("FACT_TXN"))
    assert back.schema == schemas.source_schema("FACT_TXN") and back.count() == 2
    assert glob.glob(f"{path}/*.snappy.parquet")


def test_counts_while_writing_survive_a_shuffle(spark, folder):
    df = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    assert sinks.counted_write(df, lambda d: d.write.parquet(f"{folder}/c")) == 10
    empty = df.filter("k > 100")
    assert sinks.counted_write(empty, lambda d: d.write.parquet(f"{folder}/e")) == 0


def test_load_dimension_modes(spark, folder):
    df = target(spark, "dim_continent", [{"continent_sk": 1, "continent_code": "EU"}])
    args = (f"{folder}/d", "dim_continent", "b1", TS)
    assert sinks.load_dimension(df, *args).rows_loaded == 1
    assert sinks.load_dimension(df, *args).rows_loaded == 1
    assert sinks.read_table(spark, args[0], "dim_continent").count() == 1
    sinks.load_dimension(df, *args, mode="append")
    assert sinks.read_table(spark, args[0], "dim_continent").count() == 2
    assert spark.read.parquet(args[0]).first()["_batch_id"] == "b1"
    with pytest.raises(ValueError, match="merge"):
        sinks.load_dimension(df, *args, mode="merge")
    assert sinks.read_table(spark, f"{folder}/none", "dim_continent") is None


def test_merge_upsert(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    u = spark.createDataFrame([(9, "b"), (8, "c"), (7, None)], "v int, k string")
    assert dicts(sinks.merge_upsert(t, u, ["k"])) == [("a", 1), ("b", 9), ("c", 8), (None, 7)]


def test_merge_into_touches_only_what_it_must(spark, folder):
    path = f"{folder}/m"
    rows = [("a", 1, 1), ("b", 2, 1), ("c", 3, 2), ("d", 4, 3)]
    spark.createDataFrame(rows, "k string, v int, p int").write.partitionBy("p").parquet(path)
    untouched = os.listdir(f"{path}/p=1")
    updates = spark.createDataFrame([("c", 30, 4), ("d", 40, 3), ("e", 50, 4)], "k string, v int, p int")
    for _ in range(2):
        sinks.merge_into(spark, path, updates, ["k"], "p")
        assert dicts(spark.read.parquet(path), "k", "v", "p") == [
            ("a", 1, 1),
            ("b", 2, 1),
            ("c", 30, 4),
            ("d", 40, 3),
            ("e", 50, 4),
        ]
    assert os.listdir(f"{path}/p=1") == untouched
    assert not os.path.exists(f"{path}/p=2")


def test_merge_into_and_out_of_the_null_partition(spark, folder):
    path = f"{folder}/m"
    rows = [("a", None), ("b", 1), ("c", 2)]
    spark.createDataFrame(rows, "k string, p int").write.partitionBy("p").parquet(path)
    sinks.merge_into(spark, path, spark.createDataFrame([("a", 1), ("c", None)], "k string, p int"), ["k"], "p")
    assert dicts(spark.read.parquet(path), "k", "p") == [("a", 1), ("b", 1), ("c", None)]


def test_stamps_do_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = landing.stamp_extract(spark.range(1), "T", DAY, TS)
        assert df.first()["_extracted_at"] == TS
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clustering_splits_a_hot_pair(spark, folder):
    df = spark.range(4000).select(
        F.concat(F.lit("T"), "id").alias("bk"),
        F.lit(20240101).alias("time_sk"),
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("customer_sk"),
    )
    path = f"{folder}/c"
    assert sinks.write_clustered(df, path, ["time_sk", "customer_sk"], "bk", files=8, index=["bk"]) == 4000
    files = glob.glob(f"{path}/*.parquet")
    sizes = [spark.read.parquet(f).count() for f in files]
    assert sum(sizes) == 4000 and max(sizes) < 1200
    back = spark.read.parquet(path).filter("customer_sk = 7").count()
    assert back == df.filter("customer_sk = 7").count()


def test_clustered_read_skips(spark, folder):
    df = spark.range(1000).select(F.col("id").cast("string").alias("bk"), F.col("id").alias("time_sk"))
    sinks.write_clustered(df, f"{folder}/c", ["time_sk"], "bk", files=4)
    found = spark.read.parquet(f"{folder}/c").filter("time_sk between 10 and 20")
    assert "GreaterThanOrEqual(time_sk,10)" in plan(found) and found.count() == 11
    files = [spark.read.parquet(f) for f in glob.glob(f"{folder}/c/*.parquet")]
    assert sum(f.filter("time_sk between 10 and 20").count() > 0 for f in files) == 1


def fact_rows(spark, *keys, day=20240101, reasons=()):
    rows = [
        {
            "transaction_bk": k, "time_sk": day, "customer_sk": 1, "product_sk": 1,
            "net_amount": D("1"), "batch_id": "b", "loaded_at": TS,
        }
        for k in keys
    ]
    return (
        target(spark, "fact_transactions", rows)
        .drop("transaction_sk")
        .withColumn("reasons", F.lit(list(reasons)).cast("array<string>"))
        .withColumns({c: F.array().cast("array<string>") for c in ("bad_values", "bad_raw")})
    )


def test_load_fact_again_replaces_its_window(spark, folder):
    fact, held = f"{folder}/f", f"{folder}/q"
    runs = iter(range(1, 10))

    def load(rows, batch_date, days=1):
        window = (batch_date - dt.timedelta(days=days), batch_date)
        return sinks.load_fact(rows, fact, held, next(runs), "b", batch_date, window)

    def stored(*columns):
        table = sinks.read_table(spark, fact, "fact_transactions")
        assert table.select("transaction_sk").distinct().count() == table.count()
        return dicts(table, *columns)

    def refused():
        return dicts(spark.read.schema(schemas.target_schema("quarantine_fact_transactions")).parquet(held), "transaction_bk")

    d2, d3, d4 = (dt.date(2024, 1, d) for d in (2, 3, 4))
    bad = fact_rows(spark, "Q", reasons=["UNRESOLVED_FK"])
    undated = fact_rows(spark, "U", None, day=None, reasons=["BAD_VALUE:txn_date"])
    first = load(fact_rows(spark, "A", "B").unionByName(bad).unionByName(undated), d2)
    assert (first.rows_loaded, first.rows_rejected) == (2, 3)
    load(fact_rows(spark, "C", day=20240102).unionByName(undated), d3)
    assert stored("transaction_bk") == [("A",), ("B",), ("C",)] and refused() == [("Q",), ("U",), (None,)]
    load(fact_rows(spark, "A").unionByName(bad), d2)  # B and the undated rows are gone from the source
    assert stored("transaction_bk") == [("A",), ("C",)] and refused() == [("Q",)]
    # A newer version of A; Q is good now; an older version of C comes late.
    load(fact_rows(spark, "A", "Q", day=20240103).unionByName(fact_rows(spark, "C")), d4, days=1)
    assert stored("transaction_bk", "time_sk") == [("A", 20240103), ("C", 20240102), ("Q", 20240103)]
    assert refused() == [] and not os.path.exists(f"{fact}/time_sk=20240101")
    load(fact_rows(spark, "C", day=20240103, reasons=["X"]), d4)  # the newer version is refused
    assert stored("transaction_bk") == [] and refused() == [("C",)]


def test_a_stopped_publication_is_repaired(spark, folder):
    from granary.publish import put_in_place, recover

    spark.range(3).write.parquet(f"{folder}/t")
    os.rename(f"{folder}/t", f"{folder}/_old-t")
    recover(spark, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{folder}/s")
    os.rename(f"{folder}/s/p=0", f"{folder}/s/_old-p=0")
    recover(spark, f"{folder}/s")
    assert spark.read.parquet(f"{folder}/s").count() == 4
    spark.range(5).write.parquet(f"{folder}/new")
    put_in_place(spark, f"{folder}/new", f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 5 and sorted(os.listdir(folder)) == ["s", "t"]


def test_publish_swap(spark, folder):
    for name, value in (("stage_t", 1), ("prod_t", 2)):
        spark.range(value).write.option("path", f"{folder}/{name}").saveAsTable(name)
    sinks.publish_swap(spark, "stage_t", "prod_t")
    assert (spark.table("prod_t").count(), spark.table("stage_t").count()) == (1, 2)
    spark.sql("DROP TABLE prod_t")
    sinks.publish_swap(spark, "stage_t", "prod_t")
    assert spark.table("prod_t").count() == 2 and not spark.catalog.tableExists("stage_t")
    spark.sql("DROP TABLE prod_t")


def test_table_counts(spark):
    out = sinks.table_counts({"b": spark.range(2), "a": spark.range(0)})
    assert [tuple(r) for r in out.collect()] == [("a", 0), ("b", 2)]


SPREAD = "pmod(xxhash64(id), {n})"


def check_even(df, found, rows):
    predicates = extract.even_predicates("k", found, 10, SPREAD)
    assert len(predicates) <= 22
    sizes = [r.rows_in_split for r in extract.split_sizes(df, predicates).collect()]
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert sum(sizes) == rows and df.filter(hits != 1).count() == 0
    assert max(sizes) <= max(1, 2 * rows / 10 + 2)


@pytest.mark.parametrize("values", [
    list(range(1000)), [7] * 400 + list(range(600)), [7] * 1000, [7] * 300 + [9] * 300 + [11] * 400, [None] * 500 + list(range(500)),
    [k * k for k in range(1000)], [None] * 10, [5], [], [-3] * 200 + list(range(-400, 400)), [f"it's {k % 40}" for k in range(1000)],
])
def test_even_splits(spark, values):
    """Each row is in one split, whatever the values; none has more than twice the mean where rows can be dealt out."""
    kind = "string" if values and isinstance(values[0], str) else "long"
    df = spark.createDataFrame(list(enumerate(values)), f"id long, k {kind}")
    if kind != "string":
        check_even(df, extract.depths(df, "k", 10), len(values))
    # The same from what the source itself is asked.
    con = duckdb.connect()
    con.sql(f"create table t (id bigint, k {'varchar' if kind == 'string' else 'bigint'})")
    if values:
        con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    asked = extract.depths_of(con.sql(extract.depths_query("select * from t", "k", 10)).fetchall())
    check_even(df, asked, len(values))


def test_a_heavy_value_is_one_split_without_a_spread(spark):
    df = spark.createDataFrame([(k, 7 if k < 500 else k) for k in range(1000)], "id long, k long")
    predicates = extract.even_predicates("k", extract.depths(df, "k", 10), 10)
    assert [p for p in predicates if p == "k = 7"] and max(r.rows_in_split for r in extract.split_sizes(df, predicates).collect()) == 500
