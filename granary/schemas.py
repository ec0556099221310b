"""Source and target tables, and the column mappings between them.

A mapping is a list of ``(source column, target column, type)``. Besides Spark
type names the types ``date8`` (a date held as text, ``yyyyMMdd`` or
``yyyy-MM-dd``) and ``title`` (text in title case) are known to
:mod:`granary.functions.clean`.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table and column names, types and lengths of the source system.
SOURCE_DDL = {
    "LKP_CONTINENT": "CONTINENT_CD string, CONTINENT_NM string",
    "LKP_COUNTRY": "COUNTRY_CD string, COUNTRY_NM string, CONTINENT_CD string, CURRENCY_CD string,"
    " IS_EU_FLG int, ACTIVE_FLG int",
    "LKP_REGION": "REGION_CD string, REGION_NM string, COUNTRY_CD string",
    "LKP_CITY": "CITY_ID long, CITY_NM string, POSTAL_CD string, REGION_CD string,"
    " LAT decimal(10,6), LNG decimal(10,6)",
    "LKP_PROD_LINE": "PROD_LINE_CD string, PROD_LINE_NM string, BUSINESS_UNIT string",
    "LKP_PROD_FAM": "FAMILY_CD string, FAMILY_NM string, PROD_LINE_CD string, RISK_CAT string,"
    " IS_REGULATED int",
    "DIM_PRODUCT": "PRODUCT_ID string, PRODUCT_NM string, FAMILY_CD string, ISIN_CD string,"
    " CURRENCY_CD string, MATURITY_DT string, ACTIVE_FLG int, LAST_UPD_DT date",
    "DIM_CUSTOMER": "CUST_ID string, CUST_NM string, CUST_TYPE string, CITY_ID long, SEGMENT string,"
    " KYC_STATUS string, LAST_UPD_DT date",
    "FACT_TXN": "TXN_ID string, TXN_DT string, CUST_ID string, PROD_ID string, TXN_TYPE_CD string,"
    " STATUS_CD string, CHANNEL_CD string, GROSS_AMT decimal(18,4), NET_AMT decimal(18,4),"
    " FEE_AMT decimal(18,4), TAX_AMT decimal(18,4), QTY decimal(18,6), UNIT_PRICE decimal(18,6),"
    " CURRENCY_CD string, FX_RATE_EUR decimal(10,6)",
}

# The columns of the dimensional model.
TARGET_DDL = {
    "dim_continent": "continent_sk long, continent_code string, continent_name string,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_country": "country_sk long, country_code string, country_name string, continent_sk long,"
    " currency_code string, is_eu_member boolean, is_active boolean,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_region": "region_sk long, region_code string, region_name string, country_sk long,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_city": "city_sk long, city_id long, city_name string, postal_code string, region_sk long,"
    " latitude decimal(10,6), longitude decimal(10,6),"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_product_line": "product_line_sk long, product_line_code string, product_line_name string,"
    " business_unit string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_product_family": "product_family_sk long, product_family_code string,"
    " product_family_name string, product_line_sk long, risk_category string, is_regulated boolean,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_product": "product_sk long, product_bk string, product_name string, product_family_sk long,"
    " isin_code string, currency_code string, maturity_date date, is_active boolean,"
    " valid_from date, valid_to date, is_current boolean,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_customer": "customer_sk long, customer_bk string, customer_name string,"
    " customer_type string, city_sk long, segment string, kyc_status string,"
    " valid_from date, valid_to date, is_current boolean,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "dim_time": "time_sk int, full_date date, day_of_week int, day_name string, day_of_month int,"
    " day_of_year int, week_of_year int, month_number int, month_name string, quarter int, year int,"
    " is_weekend boolean, is_public_holiday boolean, fiscal_year int, fiscal_quarter int",
    "fact_transactions": "transaction_sk long, transaction_bk string, time_sk int, customer_sk long,"
    " product_sk long, city_sk long, transaction_type string, transaction_status string,"
    " channel string, gross_amount decimal(18,4), net_amount decimal(18,4),"
    " fee_amount decimal(18,4), tax_amount decimal(18,4), quantity decimal(18,6),"
    " unit_price decimal(18,6), currency_code string, exchange_rate_to_eur decimal(10,6),"
    " amount_eur decimal(18,4), source_system string, batch_id string, loaded_at timestamp_ntz",
    "quarantine_fact_transactions": "transaction_bk string, quarantine_reason string,"
    " raw_data string, batch_id string, quarantined_at timestamp_ntz",
    "batch_audit": "run long, batch_id string, table_name string, rows_read long, rows_loaded long,"
    " rows_rejected long, rows_outdated long, extract_id string, seconds double",
}

# Longest text the declared columns take.
MAX_LENGTH = {
    "dim_continent": {"continent_code": 2, "continent_name": 100},
    "dim_country": {"country_code": 3, "country_name": 200, "currency_code": 3},
    "dim_region": {"region_code": 10, "region_name": 200},
    "dim_city": {"city_name": 200, "postal_code": 20},
    "dim_product_line": {"product_line_code": 20, "product_line_name": 200, "business_unit": 100},
    "dim_product_family": {
        "product_family_code": 20,
        "product_family_name": 200,
        "risk_category": 50,
    },
    "dim_product": {
        "product_bk": 50,
        "product_name": 300,
        "isin_code": 12,
        "currency_code": 3,
    },
    "dim_customer": {
        "customer_bk": 50,
        "customer_name": 300,
        "customer_type": 50,
        "segment": 100,
        "kyc_status": 20,
    },
    "fact_transactions": {
        "transaction_bk": 100,
        "transaction_type": 50,
        "transaction_status": 50,
        "channel": 50,
        "currency_code": 3,
    },
}

# Which source column feeds which model column.
CONTINENT_MAP = [
    ("CONTINENT_CD", "continent_code", "string"),
    ("CONTINENT_NM", "continent_name", "title"),
]
COUNTRY_MAP = [
    ("COUNTRY_CD", "country_code", "string"),
    ("COUNTRY_NM", "country_name", "string"),
    ("CONTINENT_CD", "continent_code", "string"),
    ("CURRENCY_CD", "currency_code", "string"),
    ("IS_EU_FLG", "is_eu_member", "boolean"),
    ("ACTIVE_FLG", "is_active", "boolean"),
]
REGION_MAP = [
    ("REGION_CD", "region_code", "string"),
    ("REGION_NM", "region_name", "string"),
    ("COUNTRY_CD", "country_code", "string"),
]
CITY_MAP = [
    ("CITY_ID", "city_id", "long"),
    ("CITY_NM", "city_name", "string"),
    ("POSTAL_CD", "postal_code", "string"),
    ("REGION_CD", "region_code", "string"),
    ("LAT", "latitude", "decimal(10,6)"),
    ("LNG", "longitude", "decimal(10,6)"),
]
PRODUCT_LINE_MAP = [
    ("PROD_LINE_CD", "product_line_code", "string"),
    ("PROD_LINE_NM", "product_line_name", "string"),
    ("BUSINESS_UNIT", "business_unit", "string"),
]
PRODUCT_FAMILY_MAP = [
    ("FAMILY_CD", "product_family_code", "string"),
    ("FAMILY_NM", "product_family_name", "string"),
    ("PROD_LINE_CD", "product_line_code", "string"),
    ("RISK_CAT", "risk_category", "string"),
    ("IS_REGULATED", "is_regulated", "boolean"),
]
PRODUCT_MAP = [
    ("PRODUCT_ID", "product_bk", "string"),
    ("PRODUCT_NM", "product_name", "string"),
    ("FAMILY_CD", "product_family_code", "string"),
    ("ISIN_CD", "isin_code", "string"),
    ("CURRENCY_CD", "currency_code", "string"),
    ("MATURITY_DT", "maturity_date", "date8"),
    ("ACTIVE_FLG", "is_active", "boolean"),
]
CUSTOMER_MAP = [
    ("CUST_ID", "customer_bk", "string"),
    ("CUST_NM", "customer_name", "string"),
    ("CUST_TYPE", "customer_type", "string"),
    ("CITY_ID", "city_id", "long"),
    ("SEGMENT", "segment", "string"),
    ("KYC_STATUS", "kyc_status", "string"),
]
TRANSACTION_MAP = [
    ("TXN_ID", "transaction_bk", "string"),
    ("TXN_DT", "txn_date", "date8"),
    ("CUST_ID", "customer_bk", "string"),
    ("PROD_ID", "product_bk", "string"),
    ("TXN_TYPE_CD", "transaction_type", "string"),
    ("STATUS_CD", "transaction_status", "string"),
    ("CHANNEL_CD", "channel", "string"),
    ("GROSS_AMT", "gross_amount", "decimal(18,4)"),
    ("NET_AMT", "net_amount", "decimal(18,4)"),
    ("FEE_AMT", "fee_amount", "decimal(18,4)"),
    ("TAX_AMT", "tax_amount", "decimal(18,4)"),
    ("QTY", "quantity", "decimal(18,6)"),
    ("UNIT_PRICE", "unit_price", "decimal(18,6)"),
    ("CURRENCY_CD", "currency_code", "string"),
    ("FX_RATE_EUR", "exchange_rate_to_eur", "decimal(10,6)"),
]

# Codes the transaction columns may hold.
TRANSACTION_TYPES = ["BUY", "SELL", "TRANSFER"]
TRANSACTION_STATUSES = ["SETTLED", "PENDING", "CANCELLED"]
SOURCE_SYSTEM = "ORACLE_ERP"


def source_schema(table: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[table])


def target_schema(table: str) -> StructType:
    return StructType.fromDDL(TARGET_DDL[table])
