"""The given tables in the shape of the source system.

The expressions are plain SQL that Spark and the comparing database read alike,
so that both start from the same rows. Dates move 16 years to fall inside the
calendar; amounts become decimals before any arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COUNTRY_CODE = "'N'||lpad(cast(n_nationkey as string),2,'0')"
DAY = "(year(l_shipdate)+16)*10000+month(l_shipdate)*100+day(l_shipdate)"
PRICE = "cast(l_extendedprice as decimal(12,2))"
KYC = "case when c_custkey%11=0 then null when c_custkey%5=0 then 'PENDING' else 'APPROVED' end"
CUSTOMER_TYPE = (
    "case c_custkey%3 when 0 then 'RETAIL' when 1 then 'CORPORATE' else 'INSTITUTIONAL' end"
)
CITY_ID = "cast(n_nationkey*7+k+1 as bigint)"

# name -> (base, columns). A base with "k" has one row per k in 0 .. n-1.
COLUMNS: dict[str, dict[str, str]] = {
    "LKP_CONTINENT": {
        "CONTINENT_CD": "cast(r_regionkey as string)",
        "CONTINENT_NM": "r_name",
    },
    "LKP_COUNTRY": {
        "COUNTRY_CD": COUNTRY_CODE,
        "COUNTRY_NM": "n_name",
        "CONTINENT_CD": "cast(n_regionkey as string)",
        "CURRENCY_CD": "case n_regionkey when 3 then 'EUR' when 1 then 'USD' when 2 then 'JPY'"
        " else 'GBP' end",
        "IS_EU_FLG": "case when n_regionkey=3 then 1 else 0 end",
        "ACTIVE_FLG": "1",
    },
    "LKP_REGION": {
        "REGION_CD": f"{COUNTRY_CODE}||'-R'||cast(k as string)",
        "REGION_NM": "n_name||' R'||cast(k as string)",
        "COUNTRY_CD": COUNTRY_CODE,
    },
    "LKP_CITY": {
        "CITY_ID": CITY_ID,
        "CITY_NM": "n_name||' C'||cast(k as string)",
        "POSTAL_CD": "lpad(cast(n_nationkey*100+k as string),5,'0')",
        "REGION_CD": f"{COUNTRY_CODE}||'-R'||cast(k%3 as string)",
        "LAT": "cast(n_nationkey*2.5-30 as decimal(10,6))",
        "LNG": "cast(k*12.25-40 as decimal(10,6))",
    },
    "LKP_PROD_LINE": {
        "PROD_LINE_CD": "p_type",
        "PROD_LINE_NM": "lower(p_type)",
        "BUSINESS_UNIT": "case when p_type in ('ECONOMY','SMALL') then 'Retail' else 'Markets' end",
    },
    "LKP_PROD_FAM": {
        "FAMILY_CD": "p_type||'/'||p_brand",
        "FAMILY_NM": "p_brand||' '||lower(p_type)",
        "PROD_LINE_CD": "p_type",
        "RISK_CAT": "case when p_brand in ('Brand#1','Brand#2','Brand#3') then 'HIGH'"
        " when p_brand in ('Brand#4','Brand#5') then 'MEDIUM' else 'LOW' end",
        "IS_REGULATED": "case when p_brand in ('Brand#1','Brand#4') then 1 else 0 end",
    },
    "DIM_PRODUCT": {
        "PRODUCT_ID": "'P'||cast(p_partkey as string)",
        "PRODUCT_NM": "p_name",
        "FAMILY_CD": "p_type||'/'||p_brand",
        "ISIN_CD": "case when p_partkey%10=0 then null"
        " else 'XX'||lpad(cast(p_partkey as string),10,'0') end",
        "CURRENCY_CD": "case p_partkey%3 when 0 then 'EUR' when 1 then 'USD' else 'GBP' end",
        "MATURITY_DT": "case when p_partkey%4=0 then '20300125' else '99991231' end",
        "ACTIVE_FLG": "case when p_size%5=0 then 0 else 1 end",
        "LAST_UPD_DT": "date '2011-01-01' + cast(p_partkey%2500 as int)",
    },
    "DIM_CUSTOMER": {
        "CUST_ID": "'C'||cast(c_custkey as string)",
        "CUST_NM": "c_name",
        "CUST_TYPE": CUSTOMER_TYPE,
        "CITY_ID": "cast(c_nationkey*7+c_custkey%7+1 as bigint)",
        "SEGMENT": "c_mktsegment",
        "KYC_STATUS": KYC,
        "LAST_UPD_DT": "date '2011-01-01' + cast(c_custkey%2500 as int)",
    },
    "FACT_TXN": {
        "TXN_ID": "cast(l_orderkey as string)||'-'||cast(l_linenumber as string)",
        "TXN_DT": f"cast({DAY} as string)",
        "CUST_ID": "case when l_orderkey%97=0 then 'ORPHAN' else 'C'||cast(o_custkey as string) end",
        "PROD_ID": "'P'||cast(l_partkey as string)",
        "TXN_TYPE_CD": "case l_returnflag when 'A' then 'BUY' when 'R' then 'SELL'"
        " else 'TRANSFER' end",
        "STATUS_CD": "case o_orderstatus when 'F' then 'SETTLED' when 'O' then 'PENDING'"
        " else 'CANCELLED' end",
        "CHANNEL_CD": "case when o_orderpriority in ('1-URGENT','2-HIGH') then 'API'"
        " when o_orderpriority='3-MEDIUM' then 'ONLINE' else 'BRANCH' end",
        "GROSS_AMT": f"cast({PRICE}*(1+cast(l_tax as decimal(4,2))) as decimal(18,4))",
        "NET_AMT": f"cast({PRICE}*(1-cast(l_discount as decimal(4,2))) as decimal(18,4))",
        "FEE_AMT": f"cast({PRICE}*cast(l_discount as decimal(4,2)) as decimal(18,4))",
        "TAX_AMT": f"cast({PRICE}*cast(l_tax as decimal(4,2)) as decimal(18,4))",
        "QTY": "cast(l_quantity as decimal(18,6))",
        "UNIT_PRICE": f"cast({PRICE} as decimal(18,6))",
        "CURRENCY_CD": "case l_suppkey%3 when 0 then 'EUR' when 1 then 'USD' else 'GBP' end",
        "FX_RATE_EUR": "cast(case l_suppkey%3 when 0 then '1.0' when 1 then '0.92' else '1.17' end"
        " as decimal(10,6))",
    },
}

# The customer dimension as earlier batches left it: current rows with some old
# names and statuses, and closed first versions of every tenth customer.
CUSTOMER_ATTRIBUTES = {
    "customer_type": CUSTOMER_TYPE,
    "city_sk": "cast(c_nationkey*7+c_custkey%7+1 as bigint)",
    "segment": "c_mktsegment",
}
CUSTOMER_CURRENT = {
    "customer_sk": "cast(c_custkey*2+2 as bigint)",
    "customer_bk": "'C'||cast(c_custkey as string)",
    "customer_name": "case when c_custkey%7=0 then c_name||' OLD' else c_name end",
    **CUSTOMER_ATTRIBUTES,
    "kyc_status": "case when c_custkey%13=0 or c_custkey%11=0 then null"
    " when c_custkey%5=0 then 'PENDING' else 'APPROVED' end",
    "valid_from": "case when c_custkey%10=0 then date '2014-01-01' else date '2011-01-01' end",
    "valid_to": "cast(null as date)",
    "is_current": "true",
}
CUSTOMER_CLOSED = {
    "customer_sk": "cast(c_custkey*2+1 as bigint)",
    "customer_bk": "'C'||cast(c_custkey as string)",
    "customer_name": "c_name||' V0'",
    **CUSTOMER_ATTRIBUTES,
    "kyc_status": "'PENDING'",
    "valid_from": "date '2011-01-01'",
    "valid_to": "date '2013-12-31'",
    "is_current": "false",
}
CUSTOMER_KNOWN = "c_custkey%5<>4"

# The product dimension as earlier batches left it.
PRODUCT_CURRENT = {
    "product_sk": "cast(p_partkey+1 as bigint)",
    "product_bk": "'P'||cast(p_partkey as string)",
    "product_name": "case when p_partkey%9=0 then p_name||' OLD' else p_name end",
    "product_family_sk": "cast(null as bigint)",
    "isin_code": "case when p_partkey%10=0 or p_partkey%17=0 then null"
    " else 'XX'||lpad(cast(p_partkey as string),10,'0') end",
    "currency_code": "case p_partkey%3 when 0 then 'EUR' when 1 then 'USD' else 'GBP' end",
    "maturity_date": "cast(null as date)",
    "is_active": "p_size%5<>0",
    "valid_from": "date '2012-01-01'",
    "valid_to": "cast(null as date)",
    "is_current": "true",
}
PRODUCT_KNOWN = "p_partkey%4<>3"

_COUNTED = {"LKP_REGION": 3, "LKP_CITY": 7}
_BASE = {
    "LKP_CONTINENT": "region",
    "LKP_COUNTRY": "nation",
    "LKP_REGION": "nation",
    "LKP_CITY": "nation",
    "LKP_PROD_LINE": "part",
    "LKP_PROD_FAM": "part",
    "DIM_PRODUCT": "part",
    "DIM_CUSTOMER": "customer",
}
_DISTINCT = ("LKP_PROD_LINE", "LKP_PROD_FAM")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns.items()]


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One source table as a frame."""
    columns = _columns(COLUMNS[table])
    if table == "FACT_TXN":
        orders = read(spark, sf_dir, "orders")
        lines = read(spark, sf_dir, "lineitem")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(*columns)
    base = read(spark, sf_dir, _BASE[table])
    if table in _COUNTED:
        base = base.selectExpr("*", f"explode(sequence(0, {_COUNTED[table] - 1})) as k")
    out = base.selectExpr(*columns)
    return out.distinct() if table in _DISTINCT else out


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: source(spark, sf_dir, t) for t in COLUMNS}


def customers_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "customer").filter(CUSTOMER_KNOWN)
    closed = known.filter("c_custkey%10=0").selectExpr(*_columns(CUSTOMER_CLOSED))
    return known.selectExpr(*_columns(CUSTOMER_CURRENT)).unionByName(closed)


def products_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "part").filter(PRODUCT_KNOWN)
    return known.selectExpr(*_columns(PRODUCT_CURRENT))


def _select(columns: dict[str, str]) -> str:
    return "select " + ", ".join(_columns(columns))


def source_sql(table: str) -> str:
    """The same source table as SQL."""
    select = _select(COLUMNS[table])
    if table == "FACT_TXN":
        return f"{select} from lineitem join orders on l_orderkey=o_orderkey"
    base = _BASE[table]
    if table in _COUNTED:
        base = f"(select *, unnest(range({_COUNTED[table]})) as k from {base})"
    if table in _DISTINCT:
        select = select.replace("select", "select distinct", 1)
    return f"{select} from {base}"


def customers_existing_sql() -> str:
    known = f"from customer where {CUSTOMER_KNOWN}"
    return (
        f"{_select(CUSTOMER_CURRENT)} {known} union all "
        f"{_select(CUSTOMER_CLOSED)} {known} and c_custkey%10=0"
    )


def products_existing_sql() -> str:
    return f"{_select(PRODUCT_CURRENT)} from part where {PRODUCT_KNOWN}"
