"""The key index: which day folders a batch or a lookup opens, and that it only ever changes cost."""

import datetime as dt
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granary.plans.batch import Warehouse, run_batch
from granary.session import delete_path
from granary.sinks import key_index
from granary.sinks import tables as sinks
from helpers import DAY, TS, dicts, plan, small_source, source, target, txn

NEXT, NEXT_TS = dt.date(2024, 1, 3), dt.datetime(2024, 1, 3, 3)
DAYS = ["20231228", "20231229", "20231230", "20231231", "20240101"]


def fact(spark, root):
    return dicts(Warehouse(spark, root).table("fact_transactions"), "transaction_bk", "time_sk", "net_amount")


def spoil(root, *days):
    """Make the fact's files of these days unreadable: whoever opens one fails."""
    for day in days:
        for file in Path(root, "core", "fact_transactions", f"time_sk={day}").glob("*.parquet"):
            file.write_bytes(b"not a table")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def load(spark, root, run, day, *rows):
    """Stage and publish facts given by key, day and amount, without the rest of a batch."""
    values = [{"transaction_bk": k, "time_sk": d, "net_amount": D(n), "transaction_sk": None} for k, d, n in rows]
    flagged = target(spark, "fact_transactions", values).drop("transaction_sk").withColumns(
        {c: F.array().cast("array<string>") for c in ("reasons", "bad_values", "bad_raw")}
    )
    window = None if run == 1 else (day - dt.timedelta(days=1), day)
    sinks.load_fact(flagged, f"{root}/core/fact_transactions", f"{root}/core/quarantine", run, "b", day, window)


def test_a_load_opens_only_days_that_hold_its_keys(spark, tmp_path):
    """Ascending keys and keys dealt over the days; with false hits; without an index."""
    days, night = [int(d) for d in DAYS], [("T031", 20240102, 7), *[(f"T{n}", 20240102, 100) for n in range(900, 930)]]
    for ascending in (True, False):
        stored = [(f"T{(d * 10 + i) if ascending else (i * 5 + d):03d}", day, 100) for d, day in enumerate(days) for i in range(10)]
        held = [d for k, d, _ in stored if k == "T031"]
        expected = sorted([(k, d, D(n)) for k, d, n in [r for r in stored if r[0] != "T031"] + night], key=repr)
        for case in ("plain", "spoilt", "wide", "without"):
            root = str(tmp_path / f"{case}{ascending}")
            core = f"{root}/core"
            load(spark, root, 1, DAY, *stored)
            if case == "spoilt":
                spoil(root, *set(days) - set(held))
            elif case == "wide":  # ranges as wide as can be, and hashes in days that don't hold their keys
                wide = spark.createDataFrame([(d, "", "~", 1) for d in days], key_index._RANGES)
                wide.write.mode("overwrite").parquet(f"{core}/fact_key_ranges")
                false = spark.createDataFrame([(k, d) for k in ("T031", "T900") for d in days], "k string, time_sk int")
                false = false.selectExpr("xxhash64(k) as key_hash", "time_sk", "int(time_sk / 100) as key_month")
                false.write.mode("append").partitionBy("key_month").parquet(f"{core}/fact_keys")
            elif case == "without":
                for name in ("fact_keys", "fact_key_ranges"):
                    delete_path(spark, f"{core}/{name}")
            load(spark, root, 2, NEXT, *night)
            known = {r.time_sk for r in key_index.key_ranges(spark, f"{core}/fact_transactions").collect()}
            assert known == ({*held, 20240102} if case == "without" else {*days, 20240102})
            assert key_index.last_run(spark, f"{core}/fact_transactions") == 2 or case == "spoilt"
            if case != "spoilt":
                assert fact(spark, root) == expected
            else:
                with pytest.raises(Exception, match="(?i)parquet"):
                    fact(spark, root)
                rest = [f"{core}/fact_transactions/time_sk={d}" for d in (*held, 20240102)]
                got = dicts(spark.read.parquet(*rest), "transaction_bk", "net_amount")
                assert got == sorted([(k, n) for k, d, n in expected if d in (*held, 20240102)], key=repr)


def test_days_to_open_are_those_of_the_keys(spark, folder):
    rnd, path = random.Random(5), f"{folder}/fact"
    days = list(range(20240101, 20240121))
    rows = [(n, f"{rnd.randrange(10**6):06d}", rnd.choice(days)) for n in range(2000)]
    written = spark.createDataFrame(rows, "transaction_sk long, transaction_bk string, time_sk int")
    written.write.partitionBy("time_sk").parquet(path)
    key_index.stage_index(written, path, folder, [], True)  # staged where it stands
    some = rnd.sample(rows, 4) + [(0, "no such key", 0), (0, None, 0), (0, "", 0), (0, "~", 0)]
    keys = spark.createDataFrame([(r[1],) for r in some], "transaction_bk string")
    held = {r[1] for r in some}
    expected = sorted({d for _, k, d in rows if k in held})
    assert key_index.days_to_open(keys, path) == expected
    assert key_index.days_to_open(keys, path, expected[:1]) == expected[1:]
    assert key_index.days_to_open(keys.limit(0), path) == []
    assert key_index.last_run(spark, path) == 0 and key_index.last_run(spark, f"{folder}/none/nothing") is None


def test_a_batch_and_a_lookup_open_only_days_that_hold_their_keys(spark, folder):
    rows = [txn(f"T{i * 5 + d:03d}", day=day) for d, day in enumerate(DAYS) for i in range(10)]
    run_batch(spark, small_source(spark) | {"FACT_TXN": source(spark, "FACT_TXN", rows)}, folder, DAY, TS, full=True)
    spoil(folder, "20231228", "20231230", "20231231", "20240101")
    again = [txn("T031", day="20240102", NET_AMT=D("7")), *[txn(f"T{n}", day="20240102") for n in range(900, 930)], txn("U1", day="soon")]
    run_batch(spark, small_source(spark) | {"FACT_TXN": source(spark, "FACT_TXN", again)}, folder, NEXT, NEXT_TS, max_unresolved=0.5)
    house = Warehouse(spark, folder)
    found = house.find_transactions(["T031"])
    assert "time_sk" in plan(found).split("PartitionFilters:")[1].split("]")[0]
    assert dicts(found, "transaction_bk", "time_sk", "net_amount") == [("T031", 20240102, D("7.0000"))]
    assert dicts(house.find_transactions(["T001", "T900"]), "transaction_bk", "time_sk") == [("T001", 20231229), ("T900", 20240102)]
    assert house.find_transactions(["none"]).count() == 0 and house.find_transactions([]).count() == 0
    assert house.next_run() == 3
