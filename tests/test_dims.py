import datetime as dt

from granary import schemas
from granary.operators.dims import BY_NAME, build_dimension
from helpers import TS, dicts, source, target

LATER = dt.datetime(2024, 2, 1, 3, 0, 0)


def test_continents(spark):
    raw = source(
        spark, "LKP_CONTINENT", [("EU", "europe"), ("EU", "EUROPE"), ("AM", "amerique"), (None, "x")]
    )
    out = build_dimension(BY_NAME["dim_continent"], raw, TS)
    assert out.schema.names == schemas.target_schema("dim_continent").names
    assert dicts(out, "continent_code", "continent_name") == [("AM", "Amerique"), ("EU", "Europe")]
    assert sorted(r.continent_sk for r in out.collect()) == [1, 2]
    assert out.first().created_at == TS


def test_child_points_at_parent(spark):
    parent = target(spark, "dim_continent", [{"continent_sk": 7, "continent_code": "EU"}])
    raw = source(spark, "LKP_COUNTRY", [("FRA", "France", "EU", "EUR", 1, 0), ("XXX", "Lost", "ZZ", None, 0, 1)])
    out = build_dimension(BY_NAME["dim_country"], raw, TS, parent)
    assert dicts(out, "country_code", "continent_sk", "is_eu_member", "is_active") == [
        ("FRA", 7, True, False),
        ("XXX", None, False, True),
    ]


def test_known_rows_keep_key_and_creation(spark):
    raw = source(spark, "LKP_PROD_LINE", [("EQ", "Shares", "M"), ("FI", "Bonds", "M")])
    existing = target(
        spark,
        "dim_product_line",
        [
            {"product_line_sk": 5, "product_line_code": "EQ", "product_line_name": "Old", "created_at": TS},
            {"product_line_sk": 9, "product_line_code": "GONE", "created_at": TS},
        ],
    )
    out = build_dimension(BY_NAME["dim_product_line"], raw, LATER, existing=existing)
    got = {r.product_line_code: r for r in out.collect()}
    assert (got["EQ"].product_line_sk, got["EQ"].product_line_name) == (5, "Shares")
    assert (got["EQ"].created_at, got["EQ"].updated_at) == (TS, LATER)
    assert (got["FI"].product_line_sk, got["FI"].created_at) == (10, LATER)
    assert got["GONE"].product_line_sk == 9


def test_region_key_is_code_and_country(spark):
    parent = target(
        spark,
        "dim_country",
        [{"country_sk": 1, "country_code": "FRA"}, {"country_sk": 2, "country_code": "JPN"}],
    )
    raw = source(spark, "LKP_REGION", [("N", "North F", "FRA"), ("N", "North J", "JPN"), ("N", "dup", "JPN")])
    out = build_dimension(BY_NAME["dim_region"], raw, TS, parent)
    assert dicts(out, "region_code", "country_sk") == [("N", 1), ("N", 2)]


def test_city_is_not_multiplied_by_repeated_region_codes(spark):
    parent = target(
        spark,
        "dim_region",
        [
            {"region_sk": 3, "region_code": "N", "country_sk": 1},
            {"region_sk": 4, "region_code": "N", "country_sk": 2},
        ],
    )
    raw = source(spark, "LKP_CITY", [(1, "Lille", "59000", "N"), (2, "Nowhere", None, "Z")])
    out = build_dimension(BY_NAME["dim_city"], raw, TS, parent)
    assert dicts(out, "city_id", "region_sk") == [(1, 3), (2, None)]
