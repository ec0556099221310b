"""Small frames for the tests."""

import datetime as dt
from decimal import Decimal as D

from granary import schemas

DAY = dt.date(2024, 1, 2)
TS = dt.datetime(2024, 1, 2, 3, 0, 0)


def source(spark, table, rows):
    """A source table from rows that may leave out trailing columns."""
    schema = schemas.source_schema(table)
    width = len(schema.fields)
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def target(spark, table, rows):
    """A warehouse table from dicts; absent columns are null."""
    schema = schemas.target_schema(table)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def txn(key, day="20240101", cust="CU1", prod="PR1", kind="BUY", status="SETTLED", **more):
    """One source transaction."""
    values = {
        "CHANNEL_CD": "API",
        "GROSS_AMT": D("110"),
        "NET_AMT": D("100"),
        "FEE_AMT": D("10"),
        "TAX_AMT": D("0"),
        "QTY": D("1"),
        "UNIT_PRICE": D("100"),
        "CURRENCY_CD": "EUR",
        "FX_RATE_EUR": D("1"),
    } | more
    return (key, day, cust, prod, kind, status, *values.values())


def dicts(df, *columns):
    """Rows as tuples of the named columns, sorted."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted([tuple(r) for r in rows], key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small_source(spark):
    """A complete little source system."""
    d0 = dt.date(2024, 1, 1)
    return {
        "LKP_CONTINENT": source(spark, "LKP_CONTINENT", [("EU", "EUROPE"), ("AS", "asia")]),
        "LKP_COUNTRY": source(
            spark,
            "LKP_COUNTRY",
            [("FRA", "France", "EU", "EUR", 1, 1), ("JPN", "Japan", "AS", "JPY", 0, 1)],
        ),
        "LKP_REGION": source(
            spark, "LKP_REGION", [("R1", "North", "FRA"), ("R2", "Kanto", "JPN")]
        ),
        "LKP_CITY": source(
            spark,
            "LKP_CITY",
            [
                (11, "Lille", "59000", "R1", D("50.63"), D("3.06")),
                (12, "Tokyo", "100", "R2", D("35.68"), D("139.69")),
            ],
        ),
        "LKP_PROD_LINE": source(spark, "LKP_PROD_LINE", [("EQ", "Equities", "Markets")]),
        "LKP_PROD_FAM": source(
            spark, "LKP_PROD_FAM", [("STK", "Stocks", "EQ", "MEDIUM", 0), ("OPT", "Options", "EQ", "HIGH", 1)]
        ),
        "DIM_PRODUCT": source(
            spark,
            "DIM_PRODUCT",
            [
                ("PR1", "Alpha", "STK", "XX0000000001", "EUR", "99991231", 1, d0),
                ("PR2", "Beta", "OPT", None, "USD", "20300125", 1, d0),
            ],
        ),
        "DIM_CUSTOMER": source(
            spark,
            "DIM_CUSTOMER",
            [
                ("CU1", "Ann", "RETAIL", 11, "GOLD", "APPROVED", d0),
                ("CU2", "Bob", "CORPORATE", 12, "SILVER", None, d0),
            ],
        ),
        "FACT_TXN": source(
            spark,
            "FACT_TXN",
            [
                txn("T1"),
                txn("T2", cust="CU2", prod="PR2", FX_RATE_EUR=D("1.08"), NET_AMT=D("200"), GROSS_AMT=D("220")),
                txn("T3", day="2024-01-01", kind="SELL", status="PENDING"),
                txn("T4", day="20231231", status="CANCELLED"),
            ],
        ),
    }
