"""Analytical marts over the warehouse tables.

Each function takes the tables by name. The fact is summed as early as its keys
allow: by surrogate keys of few values, map-side, before names are looked up
and the sums are brought to their final groups. A client or city with a third of
all rows is then a few rows per task, and most joins see sums, not facts.
Stored dimensions carry their real size, so Spark broadcasts the small ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.clean import minutes_crossed
from granary.operators.ranking import global_rank
from granary.operators.scd2 import current_rows
from granary.session import stage

Tables = Mapping[str, DataFrame]


def _settled(tables: Tables) -> DataFrame:
    return tables["fact_transactions"].filter(F.col("transaction_status") == "SETTLED")


def _add(
    rows: DataFrame, tables: Tables, table: str, key: str, *columns: str, current_only: bool = False
) -> DataFrame:
    """Join columns of a dimension by its key, of a history with all versions or the ``current_only``."""
    dim = tables[table]
    if current_only and "is_current" in dim.columns:
        dim = current_rows(dim)
    return rows.join(dim.select(key, *columns), key)


def _add_country(rows: DataFrame, tables: Tables) -> DataFrame:
    rows = _add(rows, tables, "dim_city", "city_sk", "region_sk")
    rows = _add(rows, tables, "dim_region", "region_sk", "country_sk")
    return _add(rows, tables, "dim_country", "country_sk", "continent_sk", "country_name")


def _average(total: str, count: str) -> Column:
    """Quotient of a summed amount and its count, with the places an average of amounts has."""
    exact = F.sum(total).cast("decimal(26,4)") / F.sum(count).cast("decimal(11,0)")
    return exact.cast("decimal(22,8)")


def _revenue(
    tables: Tables, amount: str, counted: str, more: Sequence[str], current_only: bool
) -> DataFrame:
    """Settled sums with all names the revenue marts group by.

    The city stands on the fact. Two joins by row find month and product family;
    the combinations are few, so the sums over them are small before the other
    names are added. With ``current_only`` a third join keeps the rows of
    customer versions that are current. The sums by day kept beside the fact are
    read in its place where ``tables`` has them; they don't tell versions apart.
    """
    settled = F.col("transaction_status") == "SETTLED"
    if "fact_sums" in tables and not current_only:  # sums by day instead of facts
        n = F.when(F.col(counted).isNotNull(), F.col("n")) if counted in tables["fact_sums"].columns else F.col("n")
        rows, counts = tables["fact_sums"].filter(settled), {"_counted": n, "_amounts": F.col({"net_amount": "n_net", "amount_eur": "n_eur"}[amount])}
        added = [F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in counts.items()]
    else:
        rows = tables["fact_transactions"].filter(settled)
        added = [F.count(counted).alias("_counted"), F.count(amount).alias("_amounts")]
    rows = _add(rows, tables, "dim_time", "time_sk", "year", "month_number", "month_name")
    if current_only:
        rows = _add(rows.drop("city_sk"), tables, "dim_customer", "customer_sk", "city_sk", current_only=True)
    rows = _add(rows, tables, "dim_product", "product_sk", "product_family_sk", current_only=current_only)
    sums = rows.groupBy(
        "year", "month_number", "month_name", "city_sk", "product_family_sk", "transaction_type"
    ).agg(
        *added, *[F.sum(c).alias(c) for c in [amount, *more]]
    )
    sums = _add(_add_country(sums, tables), tables, "dim_continent", "continent_sk", "continent_name")
    sums = _add(
        sums, tables, "dim_product_family", "product_family_sk", "product_line_sk", "product_family_name"
    )
    return _add(sums, tables, "dim_product_line", "product_line_sk", "product_line_name")


def monthly_revenue(tables: Tables, current_only: bool = False) -> DataFrame:
    """Settled net revenue by month, continent, country, product line, family and type.

    ``current_only`` leaves out what was booked under versions closed since.
    """
    return (
        _revenue(tables, "net_amount", "transaction_type", ["fee_amount", "quantity"], current_only)
        .groupBy(
            "year",
            "month_number",
            "month_name",
            "continent_name",
            "country_name",
            "product_line_name",
            "product_family_name",
            "transaction_type",
        )
        .agg(
            F.sum("_counted").alias("nb_transactions"),
            F.sum("net_amount").alias("revenue_eur"),
            _average("net_amount", "_amounts").alias("avg_transaction_eur"),
            F.sum("fee_amount").alias("total_fees_eur"),
            F.sum("quantity").alias("total_quantity"),
        )
    )


def monthly_revenue_eur(tables: Tables, current_only: bool = False) -> DataFrame:
    """Settled revenue in euro by month, country, continent and product line; see :func:`monthly_revenue`."""
    return (
        _revenue(tables, "amount_eur", "transaction_sk", ["fee_amount"], current_only)
        .groupBy(
            "year",
            "month_number",
            "month_name",
            "country_name",
            "continent_name",
            "product_line_name",
        )
        .agg(
            F.sum("_counted").alias("total_transactions"),
            F.sum("amount_eur").alias("total_revenue_eur"),
            _average("amount_eur", "_amounts").alias("avg_transaction_eur"),
            F.sum("fee_amount").alias("total_fees_eur"),
        )
    )


def _client_volumes(tables: Tables, current_only: bool) -> DataFrame:
    """Settled sums per client under its current name; the fact is summed by customer before any join."""
    client = ["customer_bk", "customer_name", "customer_type", "segment"]
    sums = (
        _settled(tables)
        .groupBy("customer_sk")
        .agg(
            F.count("*").alias("_rows"),
            F.count("net_amount").alias("_amounts"),
            F.sum("net_amount").alias("net_amount"),
            F.sum("fee_amount").alias("fee_amount"),
        )
    )
    if current_only:
        sums = _add(sums, tables, "dim_customer", "customer_sk", "city_sk", *client, current_only=True)
    else:
        sums = _add(sums, tables, "dim_customer", "customer_sk", "customer_bk").drop("customer_sk")
        sums = sums.groupBy("customer_bk").agg(*[F.sum(c).alias(c) for c in ("_rows", "_amounts", "net_amount", "fee_amount")])
        sums = _add(sums, tables, "dim_customer", "customer_bk", "city_sk", *client[1:], current_only=True)
    sums = _add_country(sums, tables)
    return sums.groupBy(*client, "country_name").agg(
        F.sum("_rows").alias("nb_transactions"),
        F.sum("net_amount").alias("total_volume_eur"),
        _average("net_amount", "_amounts").alias("avg_transaction_eur"),
        F.sum("fee_amount").alias("total_fees_generated"),
    )


def top_clients(tables: Tables, top: int | None = None, current_only: bool = False) -> DataFrame:
    """Settled volume per client and its rank; ``top`` keeps ranks up to it."""
    volumes = stage(_client_volumes(tables, current_only), "client-volumes")
    return global_rank(volumes, "total_volume_eur", "volume_rank", top)


def ranked_clients(tables: Tables) -> DataFrame:
    """The same for all clients as a mere plan, which sums the facts when it is run."""
    return global_rank(_client_volumes(tables, current_only=False), "total_volume_eur", "volume_rank")


def channel_analysis(tables: Tables) -> DataFrame:
    """Volume by quarter, channel, status and type; from the sums by day where ``tables`` has them."""
    if "fact_sums" in tables:
        return (
            _add(tables["fact_sums"], tables, "dim_time", "time_sk", "year", "quarter")
            .groupBy("year", "quarter", "channel", "transaction_status", "transaction_type")
            .agg(
                F.sum("n").alias("nb_transactions"),
                F.sum("net_amount").cast("decimal(28,4)").alias("total_volume_eur"),
                F.sum("fee_amount").cast("decimal(28,4)").alias("total_fees_eur"),
                _average("net_amount", "n_net").alias("avg_amount_eur"),
                F.min("least_net").alias("min_amount_eur"),
                F.max("greatest_net").alias("max_amount_eur"),
            )
        )
    return (
        _add(tables["fact_transactions"], tables, "dim_time", "time_sk", "year", "quarter")
        .groupBy("year", "quarter", "channel", "transaction_status", "transaction_type")
        .agg(
            F.count("*").alias("nb_transactions"),
            F.sum("net_amount").alias("total_volume_eur"),
            F.sum("fee_amount").alias("total_fees_eur"),
            F.avg("net_amount").alias("avg_amount_eur"),
            F.min("net_amount").alias("min_amount_eur"),
            F.max("net_amount").alias("max_amount_eur"),
        )
    )


def quality_kpi(tables: Tables) -> DataFrame:
    """One row of load and quality figures over the whole fact."""
    net = F.col("net_amount")
    return tables["fact_transactions"].agg(
        F.max("loaded_at").alias("last_load_ts"),
        F.count("*").alias("total_rows"),
        F.count_distinct("batch_id").alias("nb_batches"),
        F.count_if(F.col("customer_sk").isNull()).alias("null_customer_sk"),
        F.count_if(F.col("product_sk").isNull()).alias("null_product_sk"),
        F.count_if(net < 0).alias("negative_amounts"),
        F.count_if(F.col("gross_amount") < net).alias("gross_lt_net"),
        F.sum("net_amount").alias("total_volume_eur"),
        F.avg("net_amount").alias("avg_transaction_eur"),
    )


def batch_monitor(tables: Tables, newest: int = 10) -> DataFrame:
    """The newest batches with their rows and duration."""
    start, end = F.min("loaded_at"), F.max("loaded_at")
    return (
        tables["fact_transactions"]
        .groupBy("batch_id")
        .agg(
            F.count("*").alias("rows_loaded"),
            start.alias("batch_start"),
            end.alias("batch_end"),
        )
        .withColumn("duration_min", minutes_crossed(F.col("batch_start"), F.col("batch_end")))
        .orderBy(F.col("batch_start").desc(), "batch_id")
        .limit(newest)
    )


def revenue_by_country(tables: Tables, year: int) -> DataFrame:
    """Revenue of one year by month and country."""
    return (
        monthly_revenue(tables)
        .filter(F.col("year") == year)
        .groupBy("year", "month_name", "country_name")
        .agg(F.sum("revenue_eur").alias("ca_eur"))
        .orderBy("year", "month_name", F.col("ca_eur").desc())
    )


def top_ten(tables: Tables) -> DataFrame:
    """The ten largest clients, ties included."""
    return (
        top_clients(tables, top=10)
        .select("customer_name", "customer_type", "total_volume_eur", "volume_rank")
        .orderBy("volume_rank")
    )


def channel_quarter(tables: Tables, year: int, quarter: int) -> DataFrame:
    """Channel figures of one quarter, largest first."""
    return (
        channel_analysis(tables)
        .filter((F.col("year") == year) & (F.col("quarter") == quarter))
        .select("channel", "transaction_status", "nb_transactions", "total_volume_eur")
        .orderBy(F.col("total_volume_eur").desc())
    )


# The names of the published views.
VIEWS = {
    "V_MONTHLY_REVENUE_BY_COUNTRY": monthly_revenue,
    "V_TOP_CLIENTS": ranked_clients,
    "V_CHANNEL_ANALYSIS": channel_analysis,
    "V_PIPELINE_QUALITY_KPI": quality_kpi,
}


def create_views(spark: SparkSession, tables: Tables) -> None:
    """Offer tables and marts to SQL as temporary views; nothing is computed here.

    Spark lists a table's files when it is first read: call :func:`refresh_views`
    once they have changed, after a batch for instance.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, mart in VIEWS.items():
        mart(tables).createOrReplaceTempView(name)


def refresh_views(spark: SparkSession, tables: Tables) -> None:
    """Have the views list the files of their tables anew."""
    for name in (*tables, *VIEWS):
        spark.catalog.refreshTable(name)
