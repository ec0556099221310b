"""The transaction fact: typing, latest version, euro amounts, keys, rejects."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import schemas
from granary.functions.clean import date_key, project_checked, reasons, stamp
from granary.operators.dedup import latest_per_key
from granary.operators.scd2 import asof_lookup, current_rows

# What did not convert, see project_checked.
CHECKED = ["bad_values", "bad_raw"]

# Columns a fact row needs before it may be loaded.
REQUIRED = [
    "transaction_bk",
    "time_sk",
    "gross_amount",
    "net_amount",
    "transaction_type",
    "transaction_status",
    "currency_code",
]


def type_transactions(raw: DataFrame) -> DataFrame:
    """Model columns of the transactions, and what of them did not convert."""
    return project_checked(raw, schemas.TRANSACTION_MAP)


def latest_transactions(typed: DataFrame) -> DataFrame:
    """The newest version of each transaction; ties go by amount, product and quantity."""
    order = ["-txn_date", "-net_amount", "-gross_amount", "product_bk", "-quantity", "currency_code"]
    return latest_per_key(typed, ["transaction_bk"], order)


def amount_eur() -> Column:
    """Net amount at the row's rate, in exact decimals, rounded half up to four places."""
    product = F.col("net_amount") * F.col("exchange_rate_to_eur")
    return F.round(product, 4).try_cast("decimal(18,4)")


def resolve_keys(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    mode: str = "current",
    open_first: bool = False,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Add customer, city and product keys.

    ``current`` takes each key's current version, ``asof`` the one valid on the
    day of the transaction. No side is forced into a broadcast: Spark does so
    for a dimension whose file size allows it and shuffles both sides otherwise,
    where adaptive execution splits a customer or product with very many rows.
    """
    if mode == "asof":
        fact = asof_lookup(
            fact, dim_customer, "customer_bk", "txn_date", ["customer_sk", "city_sk"],
            open_first, first, last,
        )
        return asof_lookup(
            fact, dim_product, "product_bk", "txn_date", ["product_sk"], open_first, first, last
        )
    if mode != "current":
        raise ValueError(f"mode is 'current' or 'asof', not {mode!r}")
    customers = current_rows(dim_customer).select("customer_bk", "customer_sk", "city_sk")
    products = current_rows(dim_product).select("product_bk", "product_sk")
    return fact.join(customers, "customer_bk", "left").join(products, "product_bk", "left")


def transform_fact(
    raw: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    batch_id: str,
    batch_ts: dt.datetime,
    mode: str = "current",
    open_first: bool = False,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Source transactions as fact rows, plus the columns the reject rules look at.

    Beyond the fact table's columns the result keeps ``txn_date``, the two
    business keys and what did not convert; loading drops them.
    """
    rows = latest_transactions(type_transactions(raw)).withColumns(
        {"amount_eur": amount_eur(), "time_sk": date_key(F.col("txn_date"))}
    )
    rows = resolve_keys(rows, dim_customer, dim_product, mode, open_first, first, last)
    rows = rows.withColumns(
        {
            "source_system": F.lit(schemas.SOURCE_SYSTEM),
            "batch_id": F.lit(batch_id),
            "loaded_at": stamp(batch_ts),
        }
    )
    columns = [c for c in schemas.target_schema("fact_transactions").names if c != "transaction_sk"]
    return rows.select(*columns, "txn_date", "customer_bk", "product_bk", *CHECKED)


def reject_reasons(
    rules: Sequence[tuple[str, Column]] = (), unresolved: str = "UNRESOLVED_FK"
) -> Column:
    """All reasons to keep a fact row out of the table; empty for a good row.

    ``rules`` adds pairs of a reason and the condition under which a row fails.
    """
    keys = F.col("customer_sk").isNull() | F.col("product_sk").isNull()
    missing = [(f"MISSING:{c}", F.col(c).isNull()) for c in REQUIRED]
    amounts = F.col("net_amount").isNotNull() & F.col("exchange_rate_to_eur").isNotNull()
    too_large = ("BAD_VALUE:amount_eur", F.col("amount_eur").isNull() & amounts)
    return F.concat(reasons([(unresolved, keys), *missing, too_large, *rules]), "bad_values")


def flag_rejects(
    fact: DataFrame,
    rules: Sequence[tuple[str, Column]] = (),
    unresolved: str = "UNRESOLVED_FK",
) -> DataFrame:
    """The fact with ``reasons``; rows without any are valid."""
    return fact.withColumn("reasons", reject_reasons(rules, unresolved))


def is_valid() -> Column:
    """Whether a flagged row may be loaded."""
    return F.size("reasons") == 0


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(is_valid())


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~is_valid())


def quarantine_records(rejected: DataFrame) -> DataFrame:
    """Rejected rows as quarantine records: key, reasons, the whole row as JSON, batch, time.

    The JSON holds the text of values that did not convert under ``bad_raw``.
    """
    payload = [c for c in rejected.columns if c not in ("reasons", "bad_values")]
    return rejected.select(
        "transaction_bk",
        F.array_join("reasons", ",").alias("quarantine_reason"),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("raw_data"),
        "batch_id",
        F.col("loaded_at").alias("quarantined_at"),
    )
