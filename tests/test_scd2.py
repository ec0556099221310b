import datetime as dt
import random

import pytest

from granary.operators import scd2
from helpers import TS, dicts, plan, source, target

DAY = dt.date(2024, 6, 15)
OPEN, OLD = dt.date(2024, 1, 1), dt.date(2020, 1, 1)


def row(bk, name="N", kyc="OK", sk=1, start=OPEN, end=None, **more):
    return {
        "customer_sk": sk, "customer_bk": bk, "customer_name": name, "kyc_status": kyc,
        "valid_from": start, "valid_to": end, "is_current": end is None,
        "created_at": TS, "updated_at": TS,
    } | more


def staged(spark, *rows):
    return spark.createDataFrame(
        rows,
        "customer_bk string, customer_name string, kyc_status string, customer_type string,"
        " city_sk long, segment string",
    )


def new(bk, name="N", kyc="OK"):
    return (bk, name, kyc, "RETAIL", 1, "GOLD")


def apply(spark, existing, stage, day=DAY):
    return scd2.scd2_apply(
        target(spark, "dim_customer", existing),
        stage,
        "dim_customer",
        ["customer_bk"],
        scd2.CUSTOMER_TRACKED,
        "customer_sk",
        day,
        TS,
    )


COLS = ["customer_bk", "customer_name", "kyc_status", "valid_from", "valid_to", "is_current", "customer_sk"]
BEFORE = DAY - dt.timedelta(days=1)


def test_change_closes_and_opens(spark):
    out = apply(spark, [row("a", "Old", sk=3)], staged(spark, new("a", "New")))
    assert dicts(out, *COLS) == [
        ("a", "New", "OK", DAY, None, True, None),
        ("a", "Old", "OK", OPEN, BEFORE, False, 3),
    ]


@pytest.mark.parametrize(("was", "now"), [(None, "OK"), ("OK", None)])
def test_change_from_and_to_null_counts(spark, was, now):
    out = apply(spark, [row("a", kyc=was)], staged(spark, new("a", kyc=now)))
    assert out.count() == 2


def test_null_to_null_is_no_change(spark):
    out = apply(spark, [row("a", kyc=None)], staged(spark, new("a", kyc=None)))
    assert dicts(out, "customer_sk", "valid_from") == [(1, OPEN)]


def test_untracked_change_is_ignored(spark):
    out = apply(spark, [row("a", segment="OLD")], staged(spark, new("a")))
    assert dicts(out, "segment") == [("OLD",)]


def test_closed_history_is_untouched(spark):
    closed = row("a", "First", sk=1, start=OLD, end=dt.date(2023, 12, 31))
    out = apply(spark, [closed, row("a", "Second", sk=2)], staged(spark, new("a", "Third")))
    assert dicts(out, "customer_name", "valid_to") == [
        ("First", dt.date(2023, 12, 31)),
        ("Second", BEFORE),
        ("Third", None),
    ]


def test_absent_key_is_not_deleted(spark):
    out = apply(spark, [row("a"), row("b", sk=2)], staged(spark, new("a")))
    assert dicts(out, "customer_bk", "is_current") == [("a", True), ("b", True)]


def test_same_day_change_replaces_in_place(spark):
    out = apply(spark, [row("a", "Morning", sk=8, start=DAY)], staged(spark, new("a", "Evening")))
    assert dicts(out, *COLS) == [("a", "Evening", "OK", DAY, None, True, 8)]


def test_late_extract_does_not_undo_newer_version(spark):
    later = DAY + dt.timedelta(days=3)
    out = apply(spark, [row("a", "Newer", start=later)], staged(spark, new("a", "Older")))
    assert dicts(out, "customer_name", "valid_from") == [("Newer", later)]


def test_a_small_delta_does_not_shuffle_the_dimension(spark, folder):
    rows = [row(f"c{k}", sk=k) for k in range(3000)]
    target(spark, "dim_customer", rows).write.parquet(f"{folder}/d")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # the delta is below it, the dimension is not
    try:
        existing = spark.read.parquet(f"{folder}/d")
        out = scd2.scd2_apply(
            existing, staged(spark, new("c7", "New"), new("x")), "dim_customer", ["customer_bk"],
            scd2.CUSTOMER_TRACKED, "customer_sk", DAY, TS,
        )
        text = plan(out)
        assert "LeftAnti, BuildRight" in text and "hashpartitioning" not in text
        assert out.count() == 3002
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_changed_and_new_keys(spark):
    existing = target(spark, "dim_customer", [row("a"), row("b", kyc=None, sk=2), row("z", end=OPEN, sk=3)])
    stage = staged(spark, new("a"), new("b"), new("z"), new("c"))
    assert dicts(scd2.changed_keys(existing, stage, ["customer_bk"], scd2.CUSTOMER_TRACKED)) == [("b",)]
    assert dicts(scd2.new_keys(existing, stage, ["customer_bk"]), "customer_bk") == [("c",), ("z",)]


def test_staged_customers_are_unique_and_know_their_city(spark):
    raw = source(
        spark,
        "DIM_CUSTOMER",
        [("c1", "B", "R", 5, "S", "OK"), ("c1", "A", "R", 5, "S", "OK"), (None, "X", "R", 5, "S", "OK")],
    )
    city = target(spark, "dim_city", [{"city_sk": 70, "city_id": 5}])
    assert dicts(scd2.stage_customers(raw, city), "customer_bk", "customer_name", "city_sk") == [("c1", "A", 70)]


def test_invariants_over_many_batches(spark):
    """One current row per key, no gaps or overlaps, unique keys; a rerun changes nothing."""
    rng = random.Random(3)
    existing = None
    for n in range(4):
        day = DAY + dt.timedelta(days=n)
        rows = [new(f"k{i}", rng.choice("xy"), rng.choice(["OK", None])) for i in range(30) if rng.random() < 0.7]
        args = ["dim_customer", ["customer_bk"], scd2.CUSTOMER_TRACKED, "customer_sk", day, TS]
        built = scd2.scd2_build(existing, staged(spark, *rows), *args).collect()
        existing = spark.createDataFrame(built, target(spark, "dim_customer", []).schema)
        again = scd2.scd2_build(existing, staged(spark, *rows), *args)
        assert dicts(again) == dicts(existing)
    versions = {}
    for r in built:
        versions.setdefault(r.customer_bk, []).append(r)
    assert len({r.customer_sk for r in built}) == len(built)
    for rows in versions.values():
        rows.sort(key=lambda r: r.valid_from)
        assert [r.is_current for r in rows] == [False] * (len(rows) - 1) + [True]
        for a, b in zip(rows, rows[1:], strict=False):
            assert a.valid_to + dt.timedelta(days=1) == b.valid_from


def asof_brute(facts, dim, open_first):
    first = {}
    for k, start, *_ in dim:
        first[k] = min(start, first.get(k, start))
    out = []
    for i, k, d in facts:
        hit = None
        for dk, start, end, v in dim:
            begin = dt.date(2010, 1, 1) if open_first and start == first[dk] else start
            if dk == k and d is not None and begin <= d <= (end or dt.date(2029, 12, 31)):
                hit = v
        out.append((i, hit))
    return sorted(out, key=repr)


@pytest.mark.parametrize("open_first", [False, True])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_asof_against_brute_force(spark, open_first, broadcast):
    rng = random.Random(11)
    dim, v = [], 0
    for k in ["hot", "b", "c"]:
        start = dt.date(2012, 3, 1)
        for _ in range(400 if k == "hot" else 2):
            end = start + dt.timedelta(days=rng.randint(0, 9))
            v += 1
            dim.append((k, start, end, v))
            start = end + dt.timedelta(days=1)
        dim.append((k, start, None, v + 1))
        v += 1
    days = [dt.date(2011, 1, 1) + dt.timedelta(days=rng.randint(0, 5000)) for _ in range(300)]
    facts = [(i, rng.choice(["hot", "hot", "b", "c", "none", None]), d) for i, d in enumerate(days)]
    facts.append((999, "hot", None))
    f = spark.createDataFrame(facts, "id int, k string, d date")
    d = spark.createDataFrame(dim, "k string, valid_from date, valid_to date, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = scd2.asof_lookup(f, d, "k", "d", ["v"], open_first)
        assert dicts(got, "id", "v") == asof_brute(facts, dim, open_first)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_asof_joins_by_equality(spark):
    f = spark.createDataFrame([(1, "a", OPEN)], "id int, k string, d date")
    d = spark.createDataFrame([("a", OLD, None, 1)], "k string, valid_from date, valid_to date, v int")
    assert "NestedLoop" not in plan(scd2.asof_lookup(f, d, "k", "d", ["v"]))
