"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.calendar import dim_time
from granary.functions.clean import (
    align,
    date_key,
    minutes_crossed,
    null_normalize,
    parse_date,
    project,
    with_key,
)
from granary.operators import dedup, facts, keys, quality, scd2
from granary.operators.dims import BY_NAME, build_dimension
from granary.plans import marts
from granary.plans.batch import Warehouse, run_batch, source_totals
from granary.session import at_once, scratch_path, stage
from granary.sinks import tables as sinks
from granary.sinks.key_index import key_ranges
from granary.sources import extract, landing
from workload import source_tables as given

BATCH_DATE = dt.date(2014, 6, 15)
BATCH_TS = dt.datetime(2014, 6, 15, 2, 0, 0)
BATCH_ID = sinks.batch_name(BATCH_DATE, BATCH_TS)
SCAN_BUCKETS = 20

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# ---------------------------------------------------------------- building blocks


def _dims(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named dimensions and those they rest on, each written once."""
    parents = {"dim_customer": "dim_city", "dim_product": "dim_product_family"}
    out: dict[str, DataFrame] = {}

    def make(name: str) -> DataFrame:
        if name in out:
            return out[name]
        if name == "dim_time":
            built = dim_time(spark)
        elif name in parents:
            parent = make(parents[name])
            raw = given.source(spark, sf_dir, name.upper())
            if name == "dim_customer":
                staged, bk, tracked = scd2.stage_customers(raw, parent), "customer", scd2.CUSTOMER_TRACKED
            else:
                staged, bk, tracked = scd2.stage_products(raw, parent), "product", scd2.PRODUCT_TRACKED
            built = scd2.scd2_build(
                None, staged, name, [f"{bk}_bk"], tracked, f"{bk}_sk", BATCH_DATE, BATCH_TS
            )
        else:
            spec = BY_NAME[name]
            parent = make(spec.parent) if spec.parent else None
            built = build_dimension(spec, given.source(spark, sf_dir, spec.source), BATCH_TS, parent)
        out[name] = stage(built, name)
        return out[name]

    products = [n for n in names if n.startswith("dim_product")]
    others = [n for n in names if n not in products]
    at_once(lambda: [make(n) for n in others], lambda: [make(n) for n in products])
    return out


def _fact(spark: SparkSession, sf_dir: str, dims: dict[str, DataFrame]) -> DataFrame:
    return facts.transform_fact(
        given.source(spark, sf_dir, "FACT_TXN"),
        dims["dim_customer"],
        dims["dim_product"],
        BATCH_ID,
        BATCH_TS,
    )


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.latest_transactions(
        facts.type_transactions(given.source(spark, sf_dir, "FACT_TXN"))
    )


def _facts(spark: SparkSession, sf_dir: str, *more: str) -> dict[str, DataFrame]:
    """The fact and the dimensions it needs, with those named in ``more``."""
    dims = _dims(spark, sf_dir, "dim_customer", "dim_product", *more)
    return {**dims, "fact_transactions": _fact(spark, sf_dir, dims)}


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables of the model, the fact holding its valid rows."""
    tables = _facts(spark, sf_dir, "dim_time")
    valid = facts.valid_rows(facts.flag_rejects(tables["fact_transactions"]))
    keyed = valid.withColumn("transaction_sk", keys.load_key(1))
    stored = align(keyed, schemas.target_schema("fact_transactions"))
    return {**tables, "fact_transactions": stored}


def _exact(df: DataFrame) -> DataFrame:
    """Decimal sums in the one width both engines can name."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = f.dataType
        if kind.typeName() == "decimal" and kind.scale in (4, 6) and kind.precision > 18:
            c = c.cast(f"decimal(38,{kind.scale})").alias(f.name)
        out.append(c)
    return df.select(*out)


def _checks(df: DataFrame) -> DataFrame:
    return df.select("name", "severity", "passed", "failed_rows", "total_rows")


FACT_COLUMNS = [
    "transaction_bk",
    "time_sk",
    "txn_date",
    "customer_bk",
    "product_bk",
    "transaction_type",
    "transaction_status",
    "channel",
    "gross_amount",
    "net_amount",
    "fee_amount",
    "tax_amount",
    "quantity",
    "unit_price",
    "currency_code",
    "exchange_rate_to_eur",
    "amount_eur",
    "source_system",
    "batch_id",
    "loaded_at",
]

# ---------------------------------------------------------------- sources


@query
def incremental_window(spark, sf_dir):
    """Source rows of one batch window, cut on a date held as text."""
    txn = given.source(spark, sf_dir, "FACT_TXN")
    return extract.in_window(txn, "TXN_DT", BATCH_DATE).select("TXN_ID", "TXN_DT", "NET_AMT")


@query
def partition_bounds(spark, sf_dir):
    """Bounds of a split column."""
    lines = given.read(spark, sf_dir, "lineitem")
    return extract.partition_bounds(lines, "l_orderkey", (0, SCAN_BUCKETS))


@query
def scan_splits(spark, sf_dir):
    """Rows of each part of a partitioned read, cut by the bounds of the order key."""
    lines = given.read(spark, sf_dir, "lineitem")
    row = extract.partition_bounds(lines, "l_orderkey", (0, SCAN_BUCKETS)).first()
    predicates = extract.split_predicates("l_orderkey", *row, SCAN_BUCKETS)
    return extract.split_sizes(lines, predicates)


@query
def scan_splits_even(spark, sf_dir):
    """Even reads over a key of which one value holds a third of the rows: all rows, each once, and no read over twice the mean."""
    heavy = F.when(F.col("l_partkey") % 3 == 0, 7).otherwise(F.col("l_orderkey") * F.col("l_orderkey"))
    lines = given.read(spark, sf_dir, "lineitem").select(heavy.cast("long").alias("k"), "l_extendedprice")
    found = extract.depths(lines, "k", SCAN_BUCKETS)
    predicates = extract.even_predicates("k", found, SCAN_BUCKETS, "pmod(xxhash64(l_extendedprice), {n})")
    sizes = extract.split_sizes(lines, predicates)
    return sizes.agg(
        F.sum("rows_in_split").alias("rows_read"), (F.max("rows_in_split") <= 2 * F.sum("rows_in_split") / F.lit(SCAN_BUCKETS)).alias("even")
    )


@query
def bucket_histogram(spark, sf_dir):
    """Rows per hash bucket of the transaction key: the figures that must hold."""
    txn = given.source(spark, sf_dir, "FACT_TXN").select("TXN_ID")
    sizes = keys.bucket_histogram(txn, ["TXN_ID"], SCAN_BUCKETS)
    return sizes.agg(
        F.count("*").alias("buckets"),
        F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"),
        F.sum("rows_in_bucket").alias("rows"),
        (F.max("rows_in_bucket") <= 1.5 * F.avg("rows_in_bucket")).alias("even"),
    )


@query
def source_net_total(spark, sf_dir):
    """Net amount at the source over the batch window."""
    txn = given.source(spark, sf_dir, "FACT_TXN")
    return extract.net_total(txn, "NET_AMT", "TXN_DT", BATCH_DATE)


@query
def landing_roundtrip(spark, sf_dir):
    """The transactions written to the landing zone and read back under their schema."""
    path = landing.landing_path(scratch_path(spark, "landing"), "ERP.FACT_TXN", BATCH_DATE)
    txn = given.source(spark, sf_dir, "FACT_TXN")
    landing.write_landing(landing.stamp_extract(txn, "ERP.FACT_TXN", BATCH_DATE, BATCH_TS), path)
    return landing.read_landing(spark, path, schemas.source_schema("FACT_TXN"))


@query
def audit_stamp(spark, sf_dir):
    """Customers with their extract stamp."""
    raw = given.source(spark, sf_dir, "DIM_CUSTOMER").select("CUST_ID", "CUST_NM")
    return landing.stamp_extract(raw, "ERP.DIM_CUSTOMER", BATCH_DATE, BATCH_TS)


@query
def table_counts(spark, sf_dir):
    """Rows of every source table."""
    return sinks.table_counts(given.sources(spark, sf_dir))


# ---------------------------------------------------------------- cleaning


@query
def project_cast(spark, sf_dir):
    """Products renamed and converted, rows without a key left out."""
    raw = given.source(spark, sf_dir, "DIM_PRODUCT")
    return with_key(project(raw, schemas.PRODUCT_MAP), ["product_bk"])


@query
def null_normalize_customers(spark, sf_dir):
    return null_normalize(project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP))


_queries["null_normalize"] = _queries.pop("null_normalize_customers")


@query
def scalar_dates(spark, sf_dir):
    """Date parsing in both spellings, date keys, the day before, minutes between timestamps."""
    events = given.read(spark, sf_dir, "events")
    end = F.timestamp_add("SECOND", F.col("user_id").cast("int"), F.col("ts"))
    day = F.col("ts").cast("date")
    return events.select(
        "event_id",
        parse_date(F.date_format("ts", "yyyyMMdd")).alias("from_digits"),
        parse_date(F.date_format("ts", "yyyy-MM-dd")).alias("from_dashes"),
        parse_date(F.col("event_type")).alias("from_words"),
        date_key(day).alias("time_sk"),
        F.date_sub(day, 1).alias("day_before"),
        minutes_crossed(F.col("ts"), end).cast("long").alias("minutes"),
    )


@query
def fx_normalize(spark, sf_dir):
    """Euro amount of every source transaction."""
    typed = facts.type_transactions(given.source(spark, sf_dir, "FACT_TXN"))
    return typed.select(
        "transaction_bk",
        "net_amount",
        "exchange_rate_to_eur",
        facts.amount_eur().alias("amount_eur"),
    )


@query
def dedup_by_key(spark, sf_dir):
    """One row per transaction key."""
    txn = given.source(spark, sf_dir, "FACT_TXN").select("TXN_ID", "TXN_DT", "NET_AMT")
    return dedup.dedup_by_key(txn, ["TXN_ID"])


@query
def fact_dedup(spark, sf_dir):
    """The newest version of each transaction."""
    return _latest(spark, sf_dir).drop(*facts.CHECKED)


# ---------------------------------------------------------------- keys and dimensions


@query
def assign_surrogate_keys(spark, sf_dir):
    """Keys for all customers, those of known ones kept: the figures that must hold."""
    existing = scd2.current_rows(given.customers_existing(spark, sf_dir))
    raw = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP)
    keyed = keys.assign_surrogate_keys(raw, ["customer_bk"], "customer_sk", existing)
    known = existing.select("customer_bk", F.col("customer_sk").alias("old_sk"))
    return keyed.join(known, "customer_bk", "left").agg(
        F.count("*").alias("rows"),
        F.count_distinct("customer_sk").alias("distinct_keys"),
        F.min("customer_sk").alias("lowest"),
        F.max("customer_sk").alias("highest"),
        F.count_if(F.col("customer_sk") == F.col("old_sk")).alias("kept"),
    )


@query
def lookup_surrogate_key(spark, sf_dir):
    """Products with the key of their family, shown by the code the key stands for."""
    dims = _dims(spark, sf_dir, "dim_product_family")
    family = dims["dim_product_family"]
    raw = project(given.source(spark, sf_dir, "DIM_PRODUCT"), schemas.PRODUCT_MAP)
    keyed = keys.lookup_surrogate_key(raw, family, "product_family_code", "product_family_sk")
    names = family.select("product_family_sk", "product_family_name")
    return keyed.join(names, "product_family_sk").select(
        "product_bk", "product_family_code", "product_family_name"
    )


def _dimension(spark, sf_dir, name: str) -> DataFrame:
    """A dimension with the code of its parent in place of the keys."""
    spec = BY_NAME[name]
    made = _dims(spark, sf_dir, name)
    dim = made[name]
    if spec.parent:
        dim = dim.join(made[spec.parent].select(spec.parent_sk, spec.parent_code), spec.parent_sk, "left")
        dim = dim.drop(spec.parent_sk)
    return dim.drop(spec.sk)


@query
def dim_continent(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_continent")


@query
def dim_country(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_country")


@query
def dim_region(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_region")


@query
def dim_city(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_city")


@query
def dim_product_line(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_product_line")


@query
def dim_product_family(spark, sf_dir):
    return _dimension(spark, sf_dir, "dim_product_family")


@query
def dim_time_usage(spark, sf_dir):
    """Every day of the calendar with its parts and the source transactions on it."""
    days = (
        given.source(spark, sf_dir, "FACT_TXN")
        .groupBy(parse_date(F.col("TXN_DT")).alias("full_date"))
        .agg(F.count("*").alias("n"))
    )
    return (
        dim_time(spark)
        .join(days, "full_date", "left")
        .withColumn("transactions", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


_queries["dim_time"] = _queries.pop("dim_time_usage")

# ---------------------------------------------------------------- history

_VERSION = ["valid_from", "valid_to", "is_current"]
_CUSTOMER_OUT = ["customer_bk", "customer_name", "customer_type", "segment", "kyc_status", *_VERSION]
_PRODUCT_OUT = ["product_bk", "product_name", "isin_code", "currency_code", "is_active", *_VERSION]


def _customers_staged(spark, sf_dir) -> DataFrame:
    dims = _dims(spark, sf_dir, "dim_city")
    return scd2.stage_customers(given.source(spark, sf_dir, "DIM_CUSTOMER"), dims["dim_city"])


def _customer_history(spark, sf_dir) -> DataFrame:
    return scd2.scd2_apply(
        given.customers_existing(spark, sf_dir),
        _customers_staged(spark, sf_dir),
        "dim_customer",
        ["customer_bk"],
        scd2.CUSTOMER_TRACKED,
        "customer_sk",
        BATCH_DATE,
        BATCH_TS,
    )


@query
def current_rows(spark, sf_dir):
    return scd2.current_rows(given.customers_existing(spark, sf_dir))


@query
def scd2_changed_keys(spark, sf_dir):
    """Customers whose name or status differs from their current version."""
    staged = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP)
    existing = given.customers_existing(spark, sf_dir)
    return scd2.changed_keys(existing, staged, ["customer_bk"], scd2.CUSTOMER_TRACKED)


@query
def scd2_new_keys(spark, sf_dir):
    """Customers without a current version."""
    staged = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP)
    existing = given.customers_existing(spark, sf_dir)
    return scd2.new_keys(existing, staged, ["customer_bk"]).select("customer_bk", "customer_name")


@query
def scd2_customer(spark, sf_dir):
    """All versions of all customers after the batch."""
    return _customer_history(spark, sf_dir).select(*_CUSTOMER_OUT)


@query
def scd2_keys(spark, sf_dir):
    """Surrogate keys over the customer history: the figures that must hold."""
    rows = stage(_customer_history(spark, sf_dir), "dim_customer")
    keyed = keys.fill_surrogate_keys(rows, ["customer_bk", "valid_from"], "customer_sk")
    return keyed.agg(
        F.count("*").alias("versions"),
        F.count_distinct("customer_sk").alias("distinct_keys"),
        F.max("customer_sk").alias("highest"),
    )


@query
def scd2_initial(spark, sf_dir):
    """The first load of the customers."""
    staged = _customers_staged(spark, sf_dir)
    first = scd2.scd2_initial(staged, "dim_customer", BATCH_DATE, BATCH_TS)
    return first.select(*_CUSTOMER_OUT)


@query
def scd2_product(spark, sf_dir):
    """All versions of all products after the batch."""
    dims = _dims(spark, sf_dir, "dim_product_family")
    staged = scd2.stage_products(
        given.source(spark, sf_dir, "DIM_PRODUCT"), dims["dim_product_family"]
    )
    return scd2.scd2_apply(
        given.products_existing(spark, sf_dir),
        staged,
        "dim_product",
        ["product_bk"],
        scd2.PRODUCT_TRACKED,
        "product_sk",
        BATCH_DATE,
        BATCH_TS,
    ).select(*_PRODUCT_OUT)


@query
def fact_asof(spark, sf_dir):
    """Every transaction with the customer version valid on its day."""
    return scd2.asof_lookup(
        _latest(spark, sf_dir),
        given.customers_existing(spark, sf_dir),
        "customer_bk",
        "txn_date",
        ["customer_sk", "customer_name", "valid_from", "is_current"],
    ).select(
        "transaction_bk",
        "txn_date",
        "customer_bk",
        "net_amount",
        "customer_sk",
        "customer_name",
        "valid_from",
        "is_current",
    )


@query
def fact_asof_open(spark, sf_dir):
    """As ``fact_asof``, with days long before and after the usual calendar."""
    quantity = F.col("quantity").cast("int") % 10
    months = F.when(quantity == 0, -12 * 6).when(quantity == 1, 12 * 17).otherwise(0)
    moved = _latest(spark, sf_dir).withColumn("txn_date", F.add_months("txn_date", months))
    return scd2.asof_lookup(
        stage(moved, "moved"), given.customers_existing(spark, sf_dir), "customer_bk", "txn_date", ["customer_name", "valid_from"]
    ).select("transaction_bk", "txn_date", "customer_bk", "customer_name", "valid_from")


# ---------------------------------------------------------------- fact


@query
def fact_transform(spark, sf_dir):
    """The whole fact, its keys shown by what they stand for."""
    tables = _facts(spark, sf_dir)
    customers = tables["dim_customer"].select(
        "customer_sk", F.col("customer_name").alias("resolved_customer")
    )
    products = tables["dim_product"].select(
        "product_sk", F.col("product_name").alias("resolved_product")
    )
    cities = tables["dim_city"].select("city_sk", "city_id")
    return (
        tables["fact_transactions"]
        .join(customers, "customer_sk", "left")
        .join(products, "product_sk", "left")
        .join(cities, "city_sk", "left")
        .select(*FACT_COLUMNS, "resolved_customer", "resolved_product", "city_id")
    )


def _flagged(spark, sf_dir) -> DataFrame:
    return facts.flag_rejects(_facts(spark, sf_dir)["fact_transactions"])


@query
def fact_valid(spark, sf_dir):
    """Fact rows to be loaded."""
    return facts.valid_rows(_flagged(spark, sf_dir)).select(*FACT_COLUMNS)


@query
def fact_quarantine(spark, sf_dir):
    """Fact rows held back, with the reason."""
    rows = facts.rejected_rows(_flagged(spark, sf_dir))
    return facts.quarantine_records(rows).drop("raw_data")


@query
def quarantine_payload(spark, sf_dir):
    """Quarantine records, their payload read back from JSON."""
    rows = facts.quarantine_records(facts.rejected_rows(_flagged(spark, sf_dir)))
    field = lambda name: F.get_json_object("raw_data", f"$.{name}")
    return rows.select(
        "transaction_bk",
        field("transaction_bk").alias("raw_transaction_bk"),
        field("customer_bk").alias("raw_customer_bk"),
        field("txn_date").cast("date").alias("raw_txn_date"),
        field("net_amount").cast("decimal(18,4)").alias("raw_net_amount"),
        field("customer_sk").alias("raw_customer_sk"),
    )


@query
def quarantine_reasons(spark, sf_dir):
    """Every reason each rejected row has, with two rules added."""
    fact = _facts(spark, sf_dir)["fact_transactions"]
    rules = [
        ("FEE_ABOVE_LIMIT", F.col("fee_amount") > 5000),
        ("LARGE_QUANTITY", F.col("quantity") >= 50),
    ]
    rows = facts.rejected_rows(facts.flag_rejects(fact, rules))
    return rows.select("transaction_bk", F.array_join("reasons", ",").alias("reasons"))


# ---------------------------------------------------------------- sinks


@query
def load_dimension(spark, sf_dir):
    """The product dimension written and read back, with the rows counted while writing."""
    dims = _dims(spark, sf_dir, "dim_product")
    path = scratch_path(spark, "core-dim-product")
    done = sinks.load_dimension(
        dims["dim_product"], path, "dim_product", BATCH_ID, BATCH_TS, index=["product_bk"]
    )
    stored = spark.read.parquet(path)
    return stored.select(
        *_PRODUCT_OUT, "_batch_id", "_loaded_at", F.lit(done.rows_loaded).alias("rows_loaded")
    )


@query
def merge_upsert(spark, sf_dir):
    """All customers, the ones the dimension knows overwritten by its current rows."""
    columns = ["customer_bk", "customer_name", "kyc_status"]
    target = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP)
    updates = scd2.current_rows(given.customers_existing(spark, sf_dir))
    return sinks.merge_upsert(target.select(*columns), updates.select(*columns), ["customer_bk"])


@query
def merge_into(spark, sf_dir):
    """Customers stored by type; a third of them replaced, some under another type."""
    path = scratch_path(spark, "merged")
    columns = ["customer_bk", "customer_name", "customer_type"]
    rows = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP).select(*columns)
    rows.write.partitionBy("customer_type").parquet(path)
    moved = F.when(F.col("customer_bk").endswith("7"), "PRIVATE").otherwise(F.col("customer_type"))
    updates = rows.filter("customer_type = 'RETAIL'").select(
        "customer_bk", F.upper("customer_name").alias("customer_name"), moved.alias("customer_type"))
    sinks.merge_into(spark, path, updates, ["customer_bk"], "customer_type")
    return spark.read.parquet(path).select(*columns)


@query
def publish_swap(spark, sf_dir):
    """Two catalog tables after exchanging them."""
    path = scratch_path(spark, "swap")
    mark = path.rsplit("-", 1)[1]
    staging, production = f"staging_{mark}", f"production_{mark}"
    columns = ["customer_bk", "customer_name"]
    new = project(given.source(spark, sf_dir, "DIM_CUSTOMER"), schemas.CUSTOMER_MAP)
    old = scd2.current_rows(given.customers_existing(spark, sf_dir))
    new.select(*columns).write.option("path", f"{path}/a").saveAsTable(staging)
    old.select(*columns).write.option("path", f"{path}/b").saveAsTable(production)
    sinks.publish_swap(spark, staging, production)
    out = (
        spark.table(production)
        .withColumn("published", F.lit(True))
        .unionByName(spark.table(staging).withColumn("published", F.lit(False)))
    )
    for name in (staging, production):
        spark.sql(f"DROP TABLE {name}")
    return out


def _clustered(spark, sf_dir) -> str:
    rows = _latest(spark, sf_dir).drop(*facts.CHECKED)
    rows = rows.withColumn("time_sk", date_key(F.col("txn_date")))
    path = scratch_path(spark, "clustered")
    sinks.write_clustered(
        stage(rows, "latest"), path, ["time_sk", "customer_bk"], "transaction_bk", index=["transaction_bk"]
    )
    return path


@query
def clustered_range_read(spark, sf_dir):
    """One month of the clustered fact."""
    rows = spark.read.parquet(_clustered(spark, sf_dir))
    return rows.filter(F.col("time_sk").between(20140101, 20140131)).select(
        "transaction_bk", "time_sk", "customer_bk", "net_amount"
    )


@query
def clustered_product_read(spark, sf_dir):
    """The facts of one product, from a layout by customer and product at once."""
    tables, path = _star(spark, sf_dir), scratch_path(spark, "interleaved")
    fact = stage(tables["fact_transactions"], "fact")  # read for ranks, for boundaries and to be written
    sinks.write_clustered(fact, path, [], tie="transaction_bk", interleave=["customer_sk", "product_sk"], files=16)
    product = tables["dim_product"].agg(F.min_by("product_sk", "product_bk")).first()[0]
    rows = spark.read.parquet(path).filter(F.col("product_sk") == product)
    return rows.select("transaction_bk", "time_sk", "net_amount")


@query
def point_lookup(spark, sf_dir):
    """One transaction, found by its key."""
    rows = spark.read.parquet(_clustered(spark, sf_dir))
    key = rows.agg(F.max("transaction_bk")).first()[0]
    return rows.filter(F.col("transaction_bk") == key).select(
        "transaction_bk", "time_sk", "customer_bk", "net_amount"
    )


# ---------------------------------------------------------------- quality


def _typed(spark, sf_dir) -> DataFrame:
    return facts.type_transactions(given.source(spark, sf_dir, "FACT_TXN"))


@query
def dq_not_null(spark, sf_dir):
    """Products without an ISIN, within and beyond the tolerated share."""
    raw = project(given.source(spark, sf_dir, "DIM_PRODUCT"), schemas.PRODUCT_MAP)
    rules = [
        quality.not_null("product_bk"),
        quality.not_null("isin_code", quality.WARNING, max_null_rate=0.2),
    ]
    return _checks(quality.row_checks(raw, rules))


@query
def dq_unique(spark, sf_dir):
    """Repeated transaction keys at the source."""
    return _checks(quality.unique_check(_typed(spark, sf_dir), ["transaction_bk"]))


@query
def dim_city_ambiguous(spark, sf_dir):
    """Region codes that more than one country holds, once the country is cut off them."""
    regions = _dims(spark, sf_dir, "dim_region")["dim_region"]
    short = regions.withColumn("region_code", F.right("region_code", F.lit(2)))
    return _checks(quality.unique_check(short, ["region_code"], quality.WARNING))


@query
def dq_accepted_values(spark, sf_dir):
    rules = [
        quality.accepted_values("transaction_type", schemas.TRANSACTION_TYPES),
        quality.accepted_values("transaction_status", ["SETTLED", "PENDING"]),
    ]
    return _checks(quality.row_checks(_typed(spark, sf_dir), rules))


@query
def dq_not_negative(spark, sf_dir):
    rules = [quality.not_negative(c) for c in ("net_amount", "fee_amount", "quantity")]
    return _checks(quality.row_checks(_typed(spark, sf_dir), rules))


@query
def dq_gross_gte_net(spark, sf_dir):
    return _checks(quality.row_checks(_typed(spark, sf_dir), [quality.gross_gte_net()]))


@query
def dq_referential_integrity(spark, sf_dir):
    """Transactions whose customer or product the source tables lack."""
    customers = given.source(spark, sf_dir, "DIM_CUSTOMER").select("CUST_ID")
    products = given.source(spark, sf_dir, "DIM_PRODUCT").select("PRODUCT_ID")
    references = [
        quality.Reference("customer_bk", customers, "CUST_ID"),
        quality.Reference("product_bk", products, "PRODUCT_ID"),
    ]
    return _checks(quality.integrity_checks(_typed(spark, sf_dir), references))


@query
def dq_reconcile(spark, sf_dir):
    """Source rows against the newest versions: more than the tolerated share is missing."""
    source = given.source(spark, sf_dir, "FACT_TXN")
    target = _latest(spark, sf_dir)
    checks = quality.reconcile(source, target, "fact_transactions", "NET_AMT", "net_amount")
    return _checks(checks)


@query
def dq_reconcile_rows(spark, sf_dir):
    """Newest versions against the same with two amounts swapped: counts and totals agree, the rows are found."""
    source = stage(_latest(spark, sf_dir).select("transaction_bk", "txn_date", "net_amount"), "latest")
    key, amount = F.col("transaction_bk"), F.col("net_amount")
    ends = source.agg(F.min(key).alias("a"), F.min_by(amount, key).alias("of_a"), F.max(key).alias("b"), F.max_by(amount, key).alias("of_b")).first()
    swapped = F.when(key == ends.a, F.lit(ends.of_b)).when(key == ends.b, F.lit(ends.of_a)).otherwise(amount)
    return quality.differing_rows(source, source.withColumn("net_amount", swapped), ["transaction_bk"], ["net_amount"], "txn_date")


@query
def dq_single_pass(spark, sf_dir):
    """All rules on single fact rows in one aggregate."""
    fact = _facts(spark, sf_dir)["fact_transactions"]
    return _checks(quality.row_checks(fact, quality.fact_rules()))


def _suite(spark, sf_dir) -> DataFrame:
    tables = _facts(spark, sf_dir, "dim_time")
    checked = facts.flag_rejects(tables["fact_transactions"]).select(*quality.SUITE_COLUMNS)
    flagged, totals = at_once(
        lambda: stage(checked, "fact"),
        lambda: stage(source_totals(given.source(spark, sf_dir, "FACT_TXN")), "source-totals"),
    )
    return quality.fact_suite(
        flagged,
        facts.is_valid(),
        tables["dim_customer"],
        tables["dim_product"],
        tables["dim_time"],
        totals,
    )


@query
def dq_fact_suite(spark, sf_dir):
    """The whole fact suite: fifteen checks and two reconciliations."""
    return _checks(_suite(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    """The verdict over the fact suite."""
    return quality.report_frame(_suite(spark, sf_dir))


@query
def dq_schema(spark, sf_dir):
    """Conversion and length of the product columns at the source."""
    raw = given.source(spark, sf_dir, "DIM_PRODUCT")
    return _checks(quality.source_checks(raw, schemas.PRODUCT_MAP, "dim_product"))


# ---------------------------------------------------------------- marts


@query
def mart_monthly_revenue(spark, sf_dir):
    return _exact(marts.monthly_revenue(_star(spark, sf_dir)))


@query
def mart_monthly_revenue_eur(spark, sf_dir):
    return _exact(marts.monthly_revenue_eur(_star(spark, sf_dir)))


@query
def mart_top_clients(spark, sf_dir):
    return _exact(marts.top_clients(_star(spark, sf_dir)))


def _changed(spark, sf_dir) -> dict[str, DataFrame]:
    """The model after a tenth of the customers got a new version: the facts keep the one they were booked under."""
    tables = _star(spark, sf_dir)
    customers = tables["dim_customer"]
    changed = F.col("customer_bk").endswith("7")
    closed = customers.filter(changed).withColumns({"is_current": F.lit(False), "valid_to": F.lit(BATCH_DATE)})
    opened = customers.filter(changed).withColumn("customer_sk", F.col("customer_sk") + 10**9)
    history = customers.filter(~changed).unionByName(closed).unionByName(opened)
    return {**tables, "dim_customer": stage(history, "dim_customer")}


@query
def mart_monthly_revenue_history(spark, sf_dir):
    """Revenue stays whole when versions are closed."""
    return _exact(marts.monthly_revenue(_changed(spark, sf_dir)))


@query
def mart_monthly_revenue_current(spark, sf_dir):
    return _exact(marts.monthly_revenue(_changed(spark, sf_dir), current_only=True))


@query
def mart_monthly_revenue_eur_current(spark, sf_dir):
    return _exact(marts.monthly_revenue_eur(_changed(spark, sf_dir), current_only=True))


@query
def mart_top_clients_history(spark, sf_dir):
    return _exact(marts.top_clients(_changed(spark, sf_dir)))


@query
def mart_top_clients_current(spark, sf_dir):
    return _exact(marts.top_clients(_changed(spark, sf_dir), current_only=True))


@query
def mart_channel(spark, sf_dir):
    return _exact(marts.channel_analysis(_star(spark, sf_dir)))


def _monthly_batches(fact: DataFrame) -> DataFrame:
    """The fact as if loaded month by month, each row at a time of its own day."""
    seconds = F.col("quantity").cast("int") * 97
    return fact.withColumns(
        {
            "batch_id": F.concat(F.lit("batch_"), F.substring(F.col("time_sk").cast("string"), 1, 6)),
            "loaded_at": F.timestamp_add(
                "SECOND", seconds, F.col("txn_date").cast("timestamp_ntz")
            ),
        }
    )


@query
def mart_quality_kpi(spark, sf_dir):
    """Load and quality figures over the fact, unresolved rows included."""
    fact = _monthly_batches(_facts(spark, sf_dir)["fact_transactions"])
    return _exact(marts.quality_kpi({"fact_transactions": fact}))


@query
def mart_batch_monitor(spark, sf_dir):
    fact = _monthly_batches(_facts(spark, sf_dir)["fact_transactions"])
    return marts.batch_monitor({"fact_transactions": fact})


@query
def analyst_revenue_by_country(spark, sf_dir):
    return _exact(marts.revenue_by_country(_star(spark, sf_dir), 2014))


@query
def analyst_top10(spark, sf_dir):
    return _exact(marts.top_ten(_star(spark, sf_dir)))


@query
def analyst_channel_q1(spark, sf_dir):
    return _exact(marts.channel_quarter(_star(spark, sf_dir), 2014, 1))


# ---------------------------------------------------------------- batch


_houses: dict[tuple[str, str], tuple[Warehouse, DataFrame]] = {}


def _restated(spark, sf_dir) -> DataFrame:
    """The transactions with trouble: unreadable days, and some sent again with other amounts and a later day.

    What is sent again is valid: net and gross rise together, as a batch refuses to load a net above its gross.
    """
    txn = given.source(spark, sf_dir, "FACT_TXN")
    quantity, day, sold = F.col("QTY").cast("int"), F.col("TXN_DT"), F.col("TXN_TYPE_CD") == "SELL"
    spoiled = (F.when(sold & (quantity == 3), "15/06/2014").when(sold & (quantity == 4), "2014.06.15")
               .when(sold & (quantity == 5), None).otherwise(day))
    twice = F.array(F.lit(False), F.lit(True))  # in one pass, as the transactions are a join
    sent = F.when((quantity == 7) & day.between("20140501", "20140613"), twice).otherwise(F.array(F.lit(False)))
    again = F.col("_again")
    higher = {c: F.when(again, (F.col(c) + 1).cast("decimal(18,4)")).otherwise(F.col(c)) for c in ("NET_AMT", "GROSS_AMT")}
    dated = {"TXN_DT": F.when(again, "20140615").otherwise(spoiled)}
    return txn.withColumn("_again", F.explode(sent)).withColumns(dated | higher).drop("_again")


class _Stopped(Exception):
    """Raised in the middle of a publication, as if the driver had died."""


def _stop_before(n: int):
    """A hook for the batch's renames that raises at the n-th."""
    seen = []

    def hook(source: str, target: str) -> None:
        seen.append(target)
        if len(seen) == n:
            raise _Stopped

    return hook


def _rerun_house(spark, sf_dir, stopped: bool = False) -> tuple[Warehouse, DataFrame]:
    """A warehouse after a full load, the same night, the next two, and one of them again; and the last run's reconciliation.

    With ``stopped``, after the full load and the next two nights, of which each
    is stopped in the middle of its publication and then finished by recovery.
    """
    key = (spark.sparkContext.applicationId, sf_dir, stopped)
    if key not in _houses:
        rows = stage(_restated(spark, sf_dir), "restated")
        root = scratch_path(spark, "rerun")
        others = {t: stage(df, t.lower()) for t, df in given.sources(spark, sf_dir).items() if t != "FACT_TXN"}
        day = F.col("TXN_DT")
        unreadable = parse_date(day).isNull()
        first, night = (True, "20140613", dt.date(2014, 6, 14)), (False, "20140613", dt.date(2014, 6, 14))
        second, third, again = ((False, until, dt.date(2014, 6, d)) for until, d in (("20140614", 15), ("20140615", 16), ("20140615", 15)))
        for k, (full, until, date) in enumerate((first, second, third) if stopped else (first, night, second, third, again)):
            source = others | {"FACT_TXN": rows.filter((day <= until) | unreadable)}
            source |= {} if full else {t: others[t].limit(0) for t in ("DIM_CUSTOMER", "DIM_PRODUCT")}
            run = partial(run_batch, spark, source, root, date, dt.datetime.combine(date, dt.time(2)), full=full, max_unresolved=0.5)
            if not stopped or full:
                done = run()
                continue
            try:
                run(before_rename=_stop_before(5 * k))
            except _Stopped:
                Warehouse(spark, root).recover()
        checks = [c for c in done.report.checks if c["name"].startswith("reconciliation")]
        kept = spark.createDataFrame([(c["name"], c["passed"]) for c in checks], "name string, passed boolean")
        _houses[key] = Warehouse(spark, root), kept
    return _houses[key]


@query
def batch_recovered(spark, sf_dir):
    """The stored fact where the last two nights were stopped while they published, and recovered."""
    fact = _rerun_house(spark, sf_dir, stopped=True)[0].table("fact_transactions")
    return fact.select("transaction_bk", "time_sk", "net_amount", F.count("*").over(Window.partitionBy("transaction_sk")).alias("rows_of_key"))


@query
def batch_rerun_fact(spark, sf_dir):
    """The stored fact after five batches over troubled sources."""
    fact = _rerun_house(spark, sf_dir)[0].table("fact_transactions")
    return fact.select("transaction_bk", "time_sk", "net_amount", F.count("*").over(Window.partitionBy("transaction_sk")).alias("rows_of_key"))


@query
def batch_rerun_quarantine(spark, sf_dir):
    """The stored quarantine after the same batches."""
    records = _rerun_house(spark, sf_dir)[0].table("quarantine_fact_transactions")
    return records.select("transaction_bk", "quarantine_reason")


@query
def fact_lookup(spark, sf_dir):
    """Two transactions of the same fact, found by the key index: only the folders of their days are opened."""
    house = _rerun_house(spark, sf_dir)[0]
    ends = key_ranges(spark, house.path("fact_transactions")).agg(F.min("first_key"), F.max("last_key")).first()
    return house.find_transactions(list(ends)).select("transaction_bk", "time_sk", "net_amount")


@query
def batch_rerun_audit(spark, sf_dir):
    """The stored audit of the same batches: one row a run and table."""
    audit = _rerun_house(spark, sf_dir)[0].table("batch_audit")
    return audit.filter("table_name = 'fact_transactions'").select("run", "batch_id", "rows_read")


@query
def mart_monthly_revenue_kept(spark, sf_dir):
    """Monthly revenue of the same warehouse from the sums by day that each batch kept up."""
    return _exact(marts.monthly_revenue(_rerun_house(spark, sf_dir)[0].with_sums()))


@query
def mart_monthly_revenue_eur_kept(spark, sf_dir):
    """The same in euro."""
    return _exact(marts.monthly_revenue_eur(_rerun_house(spark, sf_dir)[0].with_sums()))


@query
def mart_channel_kept(spark, sf_dir):
    """Channels of the same warehouse from the same sums."""
    return _exact(marts.channel_analysis(_rerun_house(spark, sf_dir)[0].with_sums()))


@query
def calendar_once(spark, sf_dir):
    """The runs of the same audit that wrote the calendar: the first, as it covers the days of the others."""
    audit = _rerun_house(spark, sf_dir)[0].table("batch_audit")
    return audit.filter("table_name = 'dim_time'").select("run", "rows_loaded")


@query
def audit_single_file(spark, sf_dir):
    """Files that each run of the same audit is stored in."""
    audit = spark.read.parquet(_rerun_house(spark, sf_dir)[0].path("batch_audit"))
    return audit.groupBy("run").agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"))


def _geography_batch(spark, sf_dir, dry_run: bool):
    """A batch of two of the source tables into an empty warehouse, and that."""
    house, some = Warehouse(spark, scratch_path(spark, "geography")), ("LKP_CONTINENT", "LKP_COUNTRY")
    source = given.sources(spark, sf_dir)
    return run_batch(spark, source, house.root, BATCH_DATE, BATCH_TS, full=True, tables=some, dry_run=dry_run), house


@query
def batch_subset(spark, sf_dir):
    """A batch limited to continents and countries: what it loaded, beside the calendar of the first batch."""
    done, house = _geography_batch(spark, sf_dir, dry_run=False)
    stored = [t.select(F.lit(n).alias("table_name")) for n, t in house.tables().items() if n.startswith("dim_") and n != "dim_time"]
    return reduce(DataFrame.unionAll, stored).groupBy("table_name").agg(F.count("*").alias("rows_loaded"))


@query
def batch_dry_run(spark, sf_dir):
    """The same batch as a dry run: the extracts are landed and checked, no table is stored."""
    house = _geography_batch(spark, sf_dir, dry_run=True)[1]
    landed = [
        landing.read_landing(spark, landing.landing_path(house.root, t, BATCH_DATE), given.source(spark, sf_dir, t).schema)
        .agg(F.lit(t).alias("table_name"), F.count("*").alias("landed_rows")) for t in ("LKP_CONTINENT", "LKP_COUNTRY")
    ]
    return reduce(DataFrame.unionAll, landed).withColumn("stored", F.lit(bool(house.tables())))


@query
def batch_reconciliation(spark, sf_dir):
    """The last batch against the source itself, over the window it read."""
    return _rerun_house(spark, sf_dir)[1]


@query
def incremental_bad_dates(spark, sf_dir):
    """What a nightly batch reads of the troubled transactions: its day, and all rows without a readable one."""
    rows = extract.in_window(_restated(spark, sf_dir), "TXN_DT", BATCH_DATE, undated=True)
    return rows.select("TXN_ID", "TXN_DT", "NET_AMT")


@query
def fact_restated(spark, sf_dir):
    """The newest version of each of the troubled transactions."""
    typed = facts.type_transactions(_restated(spark, sf_dir))
    return facts.latest_transactions(typed).select("transaction_bk", "txn_date", "net_amount")


@query
def dq_schema_presence(spark, sf_dir):
    """Columns and types of the fact as built against those declared."""
    fact = _star(spark, sf_dir)["fact_transactions"]
    return _checks(quality.schema_checks(fact, schemas.target_schema("fact_transactions")))


@query
def batch_audit(spark, sf_dir):
    """A first full batch into an empty warehouse: rows read, loaded and held back per table."""
    done = run_batch(
        spark,
        given.sources(spark, sf_dir),
        scratch_path(spark, "warehouse"),
        BATCH_DATE,
        BATCH_TS,
        full=True,
        max_unresolved=0.02,
    )
    return done.audit.select("batch_id", "table_name", "rows_read", "rows_loaded", "rows_rejected")
