"""The queries of :mod:`workload.queries` as plain SQL over the given tables.

Written from the definitions, by natural keys: no surrogate key appears here.
"""

from __future__ import annotations

import datetime as dt
import re

from granary import schemas
from granary.functions.calendar import HOLIDAYS
from granary.operators.scd2 import CUSTOMER_TRACKED, PRODUCT_TRACKED
from workload import source_tables as given

DAY = dt.date(2014, 6, 15)
TS = "timestamp '2014-06-15 02:00:00'"
BATCH = "'batch_20140615_020000'"

_parse = "try_strptime({0}, '%Y%m%d')::date"
_time_sk = "cast(year({0})*10000+month({0})*100+day({0}) as int)"


def _avg(column: str) -> str:
    """Average of decimals with four places, exact to eight places, halves away from zero."""
    total = f"cast(sum({column})*10000 as hugeint)"
    n = f"count({column})"
    scaled = f"(2*{total}*10000 + sign({total})*{n}) // (2*{n})"
    return f"cast(cast({scaled} as decimal(28,0)) * cast(0.00000001 as decimal(8,8)) as decimal(22,8))"


def _initcap(column: str) -> str:
    words = f"string_split(lower({column}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


_CTE = {
    **{t: given.source_sql(t) for t in given.COLUMNS},
    "customers_existing": given.customers_existing_sql(),
    "products_existing": given.products_existing_sql(),
    "fact_latest": """
        select * exclude (rn) from (select *, row_number() over (partition by TXN_ID
            order by TXN_DT desc, NET_AMT desc, GROSS_AMT desc, PROD_ID, QTY desc, CURRENCY_CD) rn
          from FACT_TXN) x where rn=1""",
    "typed": f"""
        select TXN_ID transaction_bk, {_parse.format("TXN_DT")} txn_date, CUST_ID customer_bk,
          PROD_ID product_bk, TXN_TYPE_CD transaction_type, STATUS_CD transaction_status,
          CHANNEL_CD channel, GROSS_AMT gross_amount, NET_AMT net_amount, FEE_AMT fee_amount,
          TAX_AMT tax_amount, QTY quantity, UNIT_PRICE unit_price, CURRENCY_CD currency_code,
          FX_RATE_EUR exchange_rate_to_eur from fact_latest""",
    "customers": """
        select CUST_ID customer_bk, CUST_NM customer_name, CUST_TYPE customer_type, CITY_ID city_id,
          SEGMENT segment, KYC_STATUS kyc_status from DIM_CUSTOMER""",
    "products": f"""
        select PRODUCT_ID product_bk, PRODUCT_NM product_name, FAMILY_CD product_family_code,
          ISIN_CD isin_code, CURRENCY_CD currency_code, {_parse.format("MATURITY_DT")} maturity_date,
          ACTIVE_FLG=1 is_active from DIM_PRODUCT""",
    "fact": f"""
        select t.*, {_time_sk.format("txn_date")} time_sk,
          cast(round(net_amount*exchange_rate_to_eur, 4) as decimal(18,4)) amount_eur,
          'ORACLE_ERP' source_system, {BATCH} batch_id, {TS} loaded_at,
          c.customer_name resolved_customer, p.product_name resolved_product, c.city_id
        from typed t left join customers c using (customer_bk) left join products p using (product_bk)""",
    "valid": "select * from fact where resolved_customer is not null and resolved_product is not null",
    "rejected": "select * from fact where resolved_customer is null or resolved_product is null",
    "geo": f"""
        select CITY_ID city_id, COUNTRY_NM country_name, {_initcap("CONTINENT_NM")} continent_name
        from LKP_CITY join LKP_REGION using (REGION_CD) join LKP_COUNTRY using (COUNTRY_CD)
          join LKP_CONTINENT using (CONTINENT_CD)""",
    "settled": """
        select v.*, g.country_name, g.continent_name, c.customer_name, c.customer_type, c.segment,
          PROD_LINE_NM product_line_name, FAMILY_NM product_family_name,
          year(txn_date) "year", month(txn_date) month_number,
          left(monthname(txn_date), 3) month_name, quarter(txn_date) "quarter"
        from valid v join customers c using (customer_bk) join geo g on v.city_id=g.city_id
          join products p on v.product_bk=p.product_bk
          join LKP_PROD_FAM f on p.product_family_code=f.FAMILY_CD
          join LKP_PROD_LINE l on f.PROD_LINE_CD=l.PROD_LINE_CD
        where transaction_status='SETTLED'""",
    "monthly_batches": """
        select * replace ('batch_'||left(cast(time_sk as varchar),6) as batch_id,
          cast(txn_date as timestamp) + to_seconds(cast(floor(quantity) as int)*97) as loaded_at) from fact""",
    "restated": """
        select * replace (case when TXN_TYPE_CD='SELL' and floor(QTY)=3 then '15/06/2014'
            when TXN_TYPE_CD='SELL' and floor(QTY)=4 then '2014.06.15'
            when TXN_TYPE_CD='SELL' and floor(QTY)=5 then null else TXN_DT end as TXN_DT) from FACT_TXN
        union all by name
        select * replace ('20140615' as TXN_DT, cast(NET_AMT+1 as decimal(18,4)) as NET_AMT) from FACT_TXN
        where floor(QTY)=7 and TXN_DT between '20140501' and '20140613'""",
    "restated_days": f"""select *, {_parse.format("TXN_DT")} txn_date from restated""",
    "restated_until": f"""
        select * from (select *, row_number() over (partition by TXN_ID order by txn_date desc nulls last,
            NET_AMT desc, GROSS_AMT desc, PROD_ID, QTY desc, CURRENCY_CD) rn
          from restated_days where txn_date is null or txn_date <= date '{DAY}') x where rn=1""",
    "restated_keys": """
        select r.*, c.customer_bk is null or p.product_bk is null unresolved from restated_until r
        left join customers c on r.CUST_ID=c.customer_bk left join products p on r.PROD_ID=p.product_bk""",
    "stored_keys": f"""
        select TXN_ID transaction_bk, {_time_sk.format("txn_date")} time_sk, NET_AMT net_amount
        from restated_keys where txn_date is not null and not unresolved""",
    "restated_valid": """
        select CUST_ID customer_bk, PROD_ID product_bk, txn_date, TXN_TYPE_CD transaction_type, STATUS_CD transaction_status,
          CHANNEL_CD channel, NET_AMT net_amount, FEE_AMT fee_amount, QTY quantity, c.city_id,
          cast(round(NET_AMT*FX_RATE_EUR, 4) as decimal(18,4)) amount_eur
        from restated_keys join customers c on CUST_ID=c.customer_bk where txn_date is not null and not unresolved""",
    "top_clients": f"""
        select customer_bk, customer_name, customer_type, segment, country_name,
          count(*) nb_transactions, cast(sum(net_amount) as decimal(38,4)) total_volume_eur,
          {_avg("net_amount")} avg_transaction_eur,
          cast(sum(fee_amount) as decimal(38,4)) total_fees_generated,
          rank() over (order by sum(net_amount) desc) volume_rank
        from settled group by all""",
    "channel": f"""
        select year(txn_date) "year", quarter(txn_date) "quarter", channel, transaction_status,
          transaction_type, count(*) nb_transactions,
          cast(sum(net_amount) as decimal(38,4)) total_volume_eur,
          cast(sum(fee_amount) as decimal(38,4)) total_fees_eur, {_avg("net_amount")} avg_amount_eur,
          min(net_amount) min_amount_eur, max(net_amount) max_amount_eur
        from valid group by all""",
}


def _sql(body: str) -> str:
    """``body`` with the definitions it uses, directly or through others, put in front."""
    order: list[str] = []

    def visit(text: str, skip: str = "") -> None:
        for name, definition in _CTE.items():
            if name != skip and name not in order and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(definition, name)
                order.append(name)

    visit(body)
    ctes = ", ".join(f"{n} as ({_CTE[n]})" for n in order)
    return f"with {ctes} {body}" if order else body


def _window(column: str) -> str:
    day = DAY - dt.timedelta(days=1)
    parsed = _parse.format(column)
    return f"{parsed} >= date '{day}' and {parsed} < date '{DAY}'"


def _check(name: str, severity: str, failed: str, table: str, allowed: float = 0.0) -> str:
    return (
        f"select '{name}' \"name\", '{severity}' severity,"
        f" coalesce({failed},0)/nullif(count(*),0) <= {allowed} passed,"
        f" cast(coalesce({failed},0) as bigint) failed_rows, count(*) total_rows from {table}"
    )


def _rule(name: str, severity: str, failed: str, table: str, allowed: float = 0.0) -> str:
    return _check(name, severity, f"count(*) filter (where {failed})", table, allowed)


def _reconciliation(name: str, source: str, target: str, allowed: float) -> str:
    return (
        f"select 'reconciliation:{name}' \"name\", 'CRITICAL' severity,"
        f" abs(cast(({source}) as double)-cast(({target}) as double))/abs(cast(({source}) as double))"
        f" <= {allowed} passed, cast(0 as bigint) failed_rows, cast(0 as bigint) total_rows"
    )


def _single_rules(table: str) -> list[str]:
    customer, product = "resolved_customer is null", "resolved_product is null"
    types = ",".join(f"'{t}'" for t in schemas.TRANSACTION_TYPES)
    statuses = ",".join(f"'{t}'" for t in schemas.TRANSACTION_STATUSES)
    return [
        _rule("not_null:transaction_bk", "CRITICAL", "transaction_bk is null", table),
        _rule("not_null:time_sk", "CRITICAL", "time_sk is null", table),
        _rule("not_null:customer_sk", "CRITICAL", customer, table),
        _rule("not_null:product_sk", "CRITICAL", product, table),
        _rule("not_null:gross_amount", "CRITICAL", "gross_amount is null", table),
        _rule("not_null:net_amount", "CRITICAL", "net_amount is null", table),
        _rule("accepted_values:transaction_type", "WARNING", f"transaction_type not in ({types})", table),
        _rule(
            "accepted_values:transaction_status", "WARNING",
            f"transaction_status not in ({statuses})", table,
        ),
        _rule("not_negative:fee_amount", "WARNING", "fee_amount < 0", table),
        _rule("not_negative:net_amount", "CRITICAL", "net_amount < 0", table),
        _rule("business_rule:gross_gte_net", "CRITICAL", "gross_amount < net_amount", table),
    ]


def _suite() -> str:
    fk = "referential_integrity:{0}→{0}"
    parts = [
        *_single_rules("valid"),
        _check(
            "unique:transaction_bk", "CRITICAL", "count(*)-count(distinct transaction_bk)", "valid"
        ),
        _rule(fk.format("customer_sk"), "CRITICAL", "resolved_customer is null", "fact", 0.005),
        _rule(fk.format("product_sk"), "CRITICAL", "resolved_product is null", "fact", 0.005),
        _rule(
            fk.format("time_sk"), "CRITICAL",
            "txn_date not between date '2010-01-01' and date '2029-12-31'", "fact", 0.005,
        ),
        _reconciliation(
            "row_count:fact_transactions", "select count(*) from typed", "select count(*) from fact", 0.005
        ),
        _reconciliation(
            "amount:net_amount:fact_transactions", "select sum(net_amount) from typed",
            "select sum(net_amount) from fact", 0.001,
        ),
    ]
    return " union all ".join(parts)


def _history(table: str, key: str, tracked: list[str], columns: list[str], existing: str) -> str:
    """All versions after the batch, from the definition of each kind of row."""
    attributes = ", ".join(f"{{0}}.{c} {c}" for c in columns)
    change = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked)
    pair = f"from {existing} o join {table} n using ({key})"
    old, new = attributes.format("o"), attributes.format("n")
    return f"""
        select o.{key}, {old}, o.valid_from, o.valid_to, o.is_current
          from {existing} o where not o.is_current
        union all
        select o.{key}, {old}, o.valid_from, o.valid_to, true
          from {existing} o left join {table} n using ({key})
          where o.is_current and (n.{key} is null or not ({change}))
        union all
        select o.{key}, {old}, o.valid_from, date '{DAY}' - 1, false {pair}
          where o.is_current and ({change})
        union all
        select n.{key}, {new}, date '{DAY}', cast(null as date), true {pair}
          where o.is_current and ({change})
        union all
        select n.{key}, {new}, date '{DAY}', cast(null as date), true
          from {table} n anti join (select * from {existing} where is_current) o using ({key})"""


_CUSTOMER = ["customer_name", "customer_type", "segment", "kyc_status"]
_PRODUCT = ["product_name", "isin_code", "currency_code", "is_active"]
_FACT = """transaction_bk, time_sk, txn_date, customer_bk, product_bk, transaction_type,
    transaction_status, channel, gross_amount, net_amount, fee_amount, tax_amount, quantity, unit_price,
    currency_code, exchange_rate_to_eur, amount_eur, source_system, batch_id, loaded_at"""
_STAMPS = f"{TS} created_at, {TS} updated_at"
_HOLIDAYS = ", ".join(f"date '{d}'" for d in HOLIDAYS)


def _reasons(pairs: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"case when {cond} then '{name}' end" for name, cond in pairs)
    return f"list_filter([{cases}], lambda r: r is not null)"


def _audit() -> str:
    lookups = {
        "dim_continent": "LKP_CONTINENT",
        "dim_country": "LKP_COUNTRY",
        "dim_region": "LKP_REGION",
        "dim_city": "LKP_CITY",
        "dim_product_line": "LKP_PROD_LINE",
        "dim_product_family": "LKP_PROD_FAM",
        "dim_product": "DIM_PRODUCT",
        "dim_customer": "DIM_CUSTOMER",
    }
    rows = [
        f"select {BATCH} batch_id, '{t}' table_name, count(*) rows_read, count(*) rows_loaded,"
        f" cast(0 as bigint) rows_rejected from {src}"
        for t, src in lookups.items()
    ]
    days = "date '2029-12-31' - date '2010-01-01' + 1"
    rows.append(
        f"select {BATCH}, 'dim_time', cast({days} as bigint), cast({days} as bigint), cast(0 as bigint)"
    )
    rows.append(
        f"select {BATCH}, 'fact_transactions', (select count(*) from FACT_TXN),"
        " (select count(*) from valid), (select count(*) from rejected)"
    )
    return " union all ".join(rows)


def oracle_sql() -> dict[str, str]:
    bodies = {
        # sources
        "incremental_window": f"select TXN_ID, TXN_DT, NET_AMT from FACT_TXN where {_window('TXN_DT')}",
        "partition_bounds": "select coalesce(min(l_orderkey),0) lower_bound,"
        " coalesce(max(l_orderkey),20) upper_bound from lineitem",
        "scan_splits_even": "select count(*) rows_read, true as even from lineitem",
        "dq_reconcile_rows": """
            select transaction_bk, txn_date, case when side = 1 then net_amount when transaction_bk = a then of_b else of_a end net_amount,
              cast(side as bigint) in_source, cast(1 - side as bigint) in_target
            from typed, (select min(transaction_bk) a, arg_min(net_amount, transaction_bk) of_a, max(transaction_bk) b,
              arg_max(net_amount, transaction_bk) of_b from typed) e, (values (0), (1)) t(side)
            where transaction_bk in (a, b) and of_a <> of_b""",
        "scan_splits": """
            select cast(split as int) split, count(l_orderkey) rows_in_split
            from (select unnest(range(20)) split) s
              left join (select l_orderkey,
                  (select count(*) from (select unnest(range(1,20)) i) c
                    where l_orderkey >= lo + (hi + 1 - lo) * i // 20) part
                from lineitem, (select min(l_orderkey) lo, max(l_orderkey) hi from lineitem) b) l
              on part = split group by split""",
        "source_net_total": "select cast(coalesce(sum(NET_AMT),0) as decimal(38,4)) net_total"
        f" from FACT_TXN where {_window('TXN_DT')}",
        "landing_roundtrip": "select * from FACT_TXN",
        "audit_stamp": f"select CUST_ID, CUST_NM, {TS} _extracted_at,"
        " 'ERP.DIM_CUSTOMER_20140615_020000' _batch_id, 'ERP.DIM_CUSTOMER' _source_table"
        " from DIM_CUSTOMER",
        "table_counts": " union all ".join(
            f"select '{t}' table_name, count(*) row_count from {t}" for t in given.COLUMNS
        ),
        # cleaning
        "project_cast": "select * from products where product_bk is not null",
        "null_normalize": "select customer_bk, coalesce(customer_name,'UNKNOWN') customer_name,"
        " coalesce(customer_type,'UNKNOWN') customer_type, coalesce(city_id,-1) city_id,"
        " coalesce(segment,'UNKNOWN') segment, coalesce(kyc_status,'UNKNOWN') kyc_status from customers",
        "scalar_dates": f"""
            select event_id, cast(ts as date) from_digits, cast(ts as date) from_dashes,
              cast(null as date) from_words, {_time_sk.format("ts")} time_sk,
              cast(ts as date) - 1 day_before,
              date_diff('minute', ts, ts + to_seconds(cast(user_id as int))) "minutes" from events""",
        "fx_normalize": """
            select TXN_ID transaction_bk, NET_AMT net_amount, FX_RATE_EUR exchange_rate_to_eur,
              cast(round(NET_AMT*FX_RATE_EUR, 4) as decimal(18,4)) amount_eur from FACT_TXN""",
        "dedup_by_key": """
            select TXN_ID, TXN_DT, NET_AMT from (select *, row_number() over (partition by TXN_ID
              order by TXN_DT, NET_AMT) rn from FACT_TXN) where rn=1""",
        "fact_dedup": "select * from typed",
        # keys and dimensions
        "assign_surrogate_keys": """
            select (select count(*) from DIM_CUSTOMER) "rows",
              (select count(*) from DIM_CUSTOMER) distinct_keys, min(customer_sk) lowest,
              max(customer_sk) + (select count(*) from DIM_CUSTOMER) - count(*) highest,
              count(*) kept from customers_existing where is_current""",
        "lookup_surrogate_key": """
            select product_bk, product_family_code, FAMILY_NM product_family_name
            from products join LKP_PROD_FAM on product_family_code=FAMILY_CD""",
        "dim_continent": f"select CONTINENT_CD continent_code, {_initcap('CONTINENT_NM')} continent_name,"
        f" {_STAMPS} from LKP_CONTINENT",
        "dim_country": "select COUNTRY_CD country_code, COUNTRY_NM country_name,"
        " CONTINENT_CD continent_code, CURRENCY_CD currency_code, IS_EU_FLG=1 is_eu_member,"
        f" ACTIVE_FLG=1 is_active, {_STAMPS} from LKP_COUNTRY",
        "dim_region": "select REGION_CD region_code, REGION_NM region_name, COUNTRY_CD country_code,"
        f" {_STAMPS} from LKP_REGION",
        "dim_city": "select CITY_ID city_id, CITY_NM city_name, POSTAL_CD postal_code,"
        f" REGION_CD region_code, LAT latitude, LNG longitude, {_STAMPS} from LKP_CITY",
        "dim_product_line": "select PROD_LINE_CD product_line_code, PROD_LINE_NM product_line_name,"
        f" BUSINESS_UNIT business_unit, {_STAMPS} from LKP_PROD_LINE",
        "dim_product_family": "select FAMILY_CD product_family_code, FAMILY_NM product_family_name,"
        " PROD_LINE_CD product_line_code, RISK_CAT risk_category, IS_REGULATED=1 is_regulated,"
        f" {_STAMPS} from LKP_PROD_FAM",
        "dim_time": f"""
            select {_time_sk.format("d")} time_sk, d full_date, cast(isodow(d) as int) day_of_week,
              left(dayname(d),3) day_name, cast(day(d) as int) day_of_month,
              cast(dayofyear(d) as int) day_of_year, cast(week(d) as int) week_of_year,
              cast(month(d) as int) month_number, left(monthname(d),3) month_name,
              cast(quarter(d) as int) "quarter", cast(year(d) as int) "year", isodow(d) in (6,7) is_weekend,
              d in ({_HOLIDAYS}) is_public_holiday, cast(year(d) as int) fiscal_year,
              cast(quarter(d) as int) fiscal_quarter, coalesce(n, 0) transactions
            from (select cast(unnest(generate_series(date '2010-01-01', date '2029-12-31',
                interval 1 day)) as date) d) days
              left join (select {_parse.format("TXN_DT")} txn_day, count(*) n from FACT_TXN group by all) u
              on d=txn_day""",
        # history
        "current_rows": "select * from customers_existing where is_current",
        "scd2_changed_keys": """
            select o.customer_bk from customers_existing o join customers n using (customer_bk)
            where o.is_current and (o.customer_name is distinct from n.customer_name
              or o.kyc_status is distinct from n.kyc_status)""",
        "scd2_new_keys": """
            select customer_bk, customer_name from customers n
            where customer_bk not in (select customer_bk from customers_existing where is_current)""",
        "scd2_customer": _history(
            "customers", "customer_bk", CUSTOMER_TRACKED, _CUSTOMER, "customers_existing"
        ),
        "scd2_keys": f"""
            select count(*) versions, count(*) distinct_keys,
              (select max(customer_sk) from customers_existing)
              + count(*) - (select count(*) from customers_existing) highest from (
            {_history("customers", "customer_bk", CUSTOMER_TRACKED, _CUSTOMER, "customers_existing")}) h""",
        "scd2_initial": "select customer_bk, customer_name, customer_type, segment, kyc_status,"
        f" date '{DAY}' valid_from, cast(null as date) valid_to, true is_current from customers",
        "scd2_product": _history(
            "products", "product_bk", PRODUCT_TRACKED, _PRODUCT, "products_existing"
        ),
        "fact_asof": """
            select transaction_bk, txn_date, t.customer_bk, net_amount, customer_sk, customer_name,
              valid_from, is_current
            from typed t left join customers_existing e on t.customer_bk=e.customer_bk
              and txn_date between valid_from and coalesce(valid_to, date '2029-12-31')""",
        "fact_asof_open": """
            select transaction_bk, t.txn_date, t.customer_bk, customer_name, valid_from
            from (select * replace (cast(txn_date + to_months(case floor(quantity)%10 when 0 then -72
                when 1 then 204 else 0 end) as date) as txn_date) from typed) t
            left join customers_existing e on t.customer_bk=e.customer_bk
              and t.txn_date >= valid_from and (valid_to is null or t.txn_date <= valid_to)""",
        # fact
        "fact_transform": f"select {_FACT}, resolved_customer, resolved_product, city_id from fact",
        "fact_valid": f"select {_FACT} from valid",
        "fact_quarantine": "select transaction_bk, 'UNRESOLVED_FK' quarantine_reason, batch_id,"
        " loaded_at quarantined_at from rejected",
        "quarantine_payload": "select transaction_bk, transaction_bk raw_transaction_bk,"
        " customer_bk raw_customer_bk, txn_date raw_txn_date, net_amount raw_net_amount,"
        " cast(null as varchar) raw_customer_sk from rejected",
        "quarantine_reasons": f"""
            select transaction_bk, array_to_string(reasons, ',') reasons from (
              select transaction_bk, {
            _reasons(
                [
                    ("UNRESOLVED_FK", "resolved_customer is null or resolved_product is null"),
                    ("FEE_ABOVE_LIMIT", "fee_amount > 5000"),
                    ("LARGE_QUANTITY", "quantity >= 50"),
                ]
            )
        } reasons from fact) x where len(reasons) > 0""",
        # sinks
        "load_dimension": "select product_bk, product_name, isin_code, currency_code, is_active,"
        f" date '{DAY}' valid_from, cast(null as date) valid_to, true is_current, {BATCH} _batch_id,"
        f" {TS} _loaded_at, (select count(*) from products) rows_loaded from products",
        "merge_upsert": """
            select customer_bk, customer_name, kyc_status from customers
              anti join (select * from customers_existing where is_current) e using (customer_bk)
            union all
            select customer_bk, customer_name, kyc_status from customers_existing where is_current""",
        "publish_swap": """
            select customer_bk, customer_name, true published from customers union all
            select customer_bk, customer_name, false from customers_existing where is_current""",
        "clustered_range_read": f"""
            select transaction_bk, {_time_sk.format("txn_date")} time_sk, customer_bk, net_amount
            from typed where txn_date between date '2014-01-01' and date '2014-01-31'""",
        "clustered_product_read": """
            select transaction_bk, time_sk, net_amount from valid where product_bk = (select min(product_bk) from products)""",
        "point_lookup": f"""
            select transaction_bk, {_time_sk.format("txn_date")} time_sk, customer_bk, net_amount
            from typed where transaction_bk = (select max(transaction_bk) from typed)""",
        # quality
        "dq_not_null": _rule("not_null:product_bk", "CRITICAL", "product_bk is null", "products")
        + " union all "
        + _rule("not_null:isin_code", "WARNING", "isin_code is null", "products", 0.2),
        "dq_unique": _check(
            "unique:transaction_bk", "CRITICAL", "count(*)-count(distinct TXN_ID)", "FACT_TXN"
        ),
        "dq_accepted_values": _rule(
            "accepted_values:transaction_type",
            "WARNING",
            "TXN_TYPE_CD not in ('BUY','SELL','TRANSFER')",
            "FACT_TXN",
        )
        + " union all "
        + _rule(
            "accepted_values:transaction_status",
            "WARNING",
            "STATUS_CD not in ('SETTLED','PENDING')",
            "FACT_TXN",
        ),
        "dq_not_negative": " union all ".join(
            _rule(f"not_negative:{name}", "CRITICAL", f"{col} < 0", "FACT_TXN")
            for name, col in (("net_amount", "NET_AMT"), ("fee_amount", "FEE_AMT"), ("quantity", "QTY"))
        ),
        "dq_gross_gte_net": _rule(
            "business_rule:gross_gte_net", "CRITICAL", "GROSS_AMT < NET_AMT", "FACT_TXN"
        ),
        "dq_referential_integrity": _rule(
            "referential_integrity:customer_bk→CUST_ID",
            "CRITICAL",
            "c.CUST_ID is null",
            "FACT_TXN f left join DIM_CUSTOMER c on f.CUST_ID=c.CUST_ID",
            0.005,
        )
        + " union all "
        + _rule(
            "referential_integrity:product_bk→PRODUCT_ID",
            "CRITICAL",
            "p.PRODUCT_ID is null",
            "FACT_TXN f left join DIM_PRODUCT p on f.PROD_ID=p.PRODUCT_ID",
            0.005,
        ),
        "dq_reconcile": _reconciliation(
            "row_count:fact_transactions",
            "select count(*) from FACT_TXN",
            "select count(*) from typed",
            0.005,
        )
        + " union all "
        + _reconciliation(
            "amount:net_amount:fact_transactions",
            "select sum(NET_AMT) from FACT_TXN",
            "select sum(net_amount) from typed",
            0.001,
        ),
        "dq_single_pass": " union all ".join(_single_rules("fact")),
        "dq_fact_suite": _suite(),
        "dq_report": f"""
            select count(*) checks, count(*) filter (where passed) checks_passed,
              count(*) filter (where severity='CRITICAL' and not passed) critical_failures,
              count(*) filter (where severity='CRITICAL' and not passed) = 0 passed
            from ({_suite()}) checks""",
        "dq_schema": " union all ".join(
            [
                _rule(
                    "type:MATURITY_DT",
                    "CRITICAL",
                    f"MATURITY_DT is not null and {_parse.format('MATURITY_DT')} is null",
                    "DIM_PRODUCT",
                ),
                _rule("type:ACTIVE_FLG", "CRITICAL", "ACTIVE_FLG not in (0,1)", "DIM_PRODUCT"),
                *[
                    _rule(f"max_length:{s}", "CRITICAL", f"length({s}) > {n}", "DIM_PRODUCT")
                    for s, n in (
                        ("PRODUCT_ID", 50),
                        ("PRODUCT_NM", 300),
                        ("ISIN_CD", 12),
                        ("CURRENCY_CD", 3),
                    )
                ],
            ]
        ),
        # marts
        "mart_monthly_revenue": f"""
            select "year", month_number, month_name, continent_name, country_name, product_line_name,
              product_family_name, transaction_type, count(*) nb_transactions,
              cast(sum(net_amount) as decimal(38,4)) revenue_eur, {_avg("net_amount")} avg_transaction_eur,
              cast(sum(fee_amount) as decimal(38,4)) total_fees_eur,
              cast(sum(quantity) as decimal(38,6)) total_quantity from settled group by all""",
        "mart_monthly_revenue_eur": f"""
            select "year", month_number, month_name, country_name, continent_name, product_line_name,
              count(*) total_transactions, cast(sum(amount_eur) as decimal(38,4)) total_revenue_eur,
              {_avg("amount_eur")} avg_transaction_eur,
              cast(sum(fee_amount) as decimal(38,4)) total_fees_eur from settled group by all""",
        "mart_top_clients": "select * from top_clients",
        "mart_channel": "select * from channel",
        "mart_quality_kpi": f"""
            select max(loaded_at) last_load_ts, count(*) total_rows, count(distinct batch_id) nb_batches,
              count(*) filter (where resolved_customer is null) null_customer_sk,
              count(*) filter (where resolved_product is null) null_product_sk,
              count(*) filter (where net_amount < 0) negative_amounts,
              count(*) filter (where gross_amount < net_amount) gross_lt_net,
              cast(sum(net_amount) as decimal(38,4)) total_volume_eur,
              {_avg("net_amount")} avg_transaction_eur from monthly_batches""",
        "mart_batch_monitor": """
            select batch_id, count(*) rows_loaded, min(loaded_at) batch_start, max(loaded_at) batch_end,
              date_diff('minute', min(loaded_at), max(loaded_at)) duration_min
            from monthly_batches group by batch_id order by batch_start desc, batch_id limit 10""",
        "analyst_revenue_by_country": """
            select "year", month_name, country_name, cast(sum(net_amount) as decimal(38,4)) ca_eur
            from settled where "year"=2014 group by all""",
        "analyst_top10": "select customer_name, customer_type, total_volume_eur, volume_rank"
        " from top_clients where volume_rank <= 10",
        "analyst_channel_q1": "select channel, transaction_status, nb_transactions, total_volume_eur"
        ' from channel where "year"=2014 and "quarter"=1',
        "batch_audit": _audit(),
        "dim_city_ambiguous": "select 'unique:region_code' as name, 'WARNING' severity,"
        " count(*) = count(distinct right(REGION_CD, 2)) passed,"
        " count(*) - count(distinct right(REGION_CD, 2)) failed_rows, count(*) total_rows from LKP_REGION",
        "bucket_histogram": "select cast(20 as bigint) buckets, cast(0 as int) first_bucket,"
        " cast(19 as int) last_bucket, count(*) as rows, true as even from FACT_TXN",
        "merge_into": """
            select customer_bk, case when customer_type='RETAIL' then upper(customer_name) else customer_name end customer_name,
              case when customer_type='RETAIL' and customer_bk like '%7' then 'PRIVATE' else customer_type end customer_type
            from customers""",
        "incremental_bad_dates": f"""
            select TXN_ID, TXN_DT, NET_AMT from restated_days
            where txn_date is null or txn_date = date '{DAY - dt.timedelta(days=1)}'""",
        "fact_restated": """
            select TXN_ID transaction_bk, txn_date, NET_AMT net_amount from (
              select *, row_number() over (partition by TXN_ID order by txn_date desc nulls last,
                NET_AMT desc, GROSS_AMT desc, PROD_ID, QTY desc, CURRENCY_CD) rn from restated_days) x where rn=1""",
        "batch_rerun_fact": f"""
            select TXN_ID transaction_bk, {_time_sk.format("txn_date")} time_sk, NET_AMT net_amount,
              cast(1 as bigint) rows_of_key from restated_keys where txn_date is not null and not unresolved""",
        "fact_lookup": """
            select * from stored_keys where transaction_bk in
              ((select min(transaction_bk) from stored_keys), (select max(transaction_bk) from stored_keys))""",
        "calendar_once": """
            select cast(1 as bigint) run, cast(date_diff('day', least(date '2010-01-01', date_trunc('year', min(txn_date))),
              greatest(date '2029-12-31', date_trunc('year', max(txn_date)) + interval 1 year - interval 1 day)) + 1 as bigint) rows_loaded
            from restated_until where txn_date < date '2014-06-14'""",
        "audit_single_file": " union all ".join(f"select cast({n} as bigint) run, cast(1 as bigint) files" for n in range(1, 6)),
        "batch_subset": """
            select 'dim_continent' table_name, count(*) rows_loaded from LKP_CONTINENT
            union all select 'dim_country', count(*) from LKP_COUNTRY""",
        "batch_dry_run": """
            select 'LKP_CONTINENT' table_name, count(*) landed_rows, false stored from LKP_CONTINENT
            union all select 'LKP_COUNTRY', count(*), false from LKP_COUNTRY""",
        "batch_rerun_quarantine": """
            select TXN_ID transaction_bk, array_to_string(list_filter([
                case when unresolved then 'UNRESOLVED_FK' end, case when txn_date is null then 'MISSING:time_sk' end,
                case when txn_date is null and TXN_DT is not null then 'BAD_VALUE:txn_date' end], lambda x: x is not null), ',')
              quarantine_reason from restated_keys where txn_date is null or unresolved""",
        "batch_rerun_audit": " union all ".join(
            f"select cast({run} as bigint) run, 'batch_{day:%Y%m%d}_020000' batch_id, count(*) rows_read"
            f" from restated_days where txn_date is null or {reads}"
            for run, (day, reads) in enumerate(
                [
                    (dt.date(2014, 6, 14), "txn_date <= date '2014-06-13'"),
                    (dt.date(2014, 6, 14), "txn_date = date '2014-06-13'"),
                    (dt.date(2014, 6, 15), "txn_date = date '2014-06-14'"),
                    (dt.date(2014, 6, 16), "txn_date = date '2014-06-15'"),
                    (dt.date(2014, 6, 15), "txn_date = date '2014-06-14'"),
                ],
                1,
            )
        ),
        "batch_reconciliation": "select 'reconciliation:' || x as name, true as passed from"
        " (values ('row_count:fact_transactions'), ('amount:net_amount:fact_transactions')) t(x)",
        "dq_schema_presence": " union all ".join(
            f"select '{kind}:{name}' as name, 'CRITICAL' severity, true passed,"
            " cast(0 as bigint) failed_rows, cast(0 as bigint) total_rows"
            for name in re.findall(r"(\w+) [a-z]", schemas.TARGET_DDL["fact_transactions"])
            for kind in ("column_present", "column_type")
        ),
    }
    bodies["batch_recovered"] = bodies["batch_rerun_fact"]
    unchanged = "(select * from settled where customer_bk not like '%7') s"
    for name in ("mart_monthly_revenue", "mart_monthly_revenue_eur"):
        bodies[f"{name}_current"] = bodies[name].replace("from settled", f"from {unchanged}")
    stored = "(" + _CTE["settled"].replace("from valid v", "from restated_valid v") + ") s"
    for name in ("mart_monthly_revenue", "mart_monthly_revenue_eur"):
        bodies[f"{name}_kept"] = bodies[name].replace("from settled", f"from {stored}")
    bodies["mart_channel_kept"] = _CTE["channel"].replace("from valid", "from restated_valid")
    bodies["mart_monthly_revenue_history"] = bodies["mart_monthly_revenue"]
    bodies["mart_top_clients_history"] = bodies["mart_top_clients"]
    bodies["mart_top_clients_current"] = _CTE["top_clients"].replace("from settled", f"from {unchanged}")
    return {name: _sql(" ".join(body.split())) for name, body in bodies.items()}
