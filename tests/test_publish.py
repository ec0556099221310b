"""A publication that is stopped anywhere ends as if nothing had happened."""

import os
import shutil

import pytest

from granary import publish as p
from granary.plans import batch
from granary.plans.batch import Warehouse, run_batch
from helpers import DAY, TS, dicts, small_source, source, txn
from test_batch import NEXT, NEXT_TS


class Stop(Exception):
    pass


def stop_before(n):
    """A hook that raises at the n-th rename, from 0 on, and counts those before."""
    seen = []

    def hook(*rename):
        if len(seen) == n:
            raise Stop
        seen.append(rename)

    return hook, seen


def listing(root):
    """Every data file with its bytes, and nothing of the publication itself."""
    out = {}
    for folder, _, names in os.walk(root):
        for name in names:
            path = os.path.join(folder, name)
            if not name.endswith(".crc"):
                with open(path, "rb") as data:
                    out[os.path.relpath(path, root)] = data.read()
    return out


def write(path, **files):
    os.makedirs(path, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(path, name), "w") as out:
            out.write(text)


def scene(root):
    """Tables before, what is staged, and the moves: a whole table, a new one, folders replaced, added and emptied, files added."""
    for day in (1, 2, 3):
        write(f"{root}/core/fact/d={day}", a=f"old {day}")
    write(f"{root}/core/dim", a="old", b="old")
    write(f"{root}/core/audit/d=1", one="old")
    write(f"{root}/_staging/dim", a="new")
    write(f"{root}/_staging/fresh", a="new")
    for day in (2, 4):
        write(f"{root}/_staging/fact/d={day}", a=f"new {day}")
    write(f"{root}/_staging/audit/d=1", two="new")


def moves(spark, root):
    return (
        p.whole(f"{root}/_staging/dim", f"{root}/core/dim") + p.whole(f"{root}/_staging/fresh", f"{root}/core/fresh")
        + p.by_folder(spark, f"{root}/_staging/fact", f"{root}/core/fact", ["d=3", "d=9"])
        + p.added_files(spark, f"{root}/_staging/audit", f"{root}/core/audit")
    )


DONE = {
    "core/fact/d=1/a": b"old 1", "core/fact/d=2/a": b"new 2", "core/fact/d=4/a": b"new 4", "core/dim/a": b"new", "core/fresh/a": b"new",
    "core/audit/d=1/one": b"old", "core/audit/d=1/two": b"new",
}


def test_stopped_before_every_rename(spark, folder):
    n = 0
    while True:
        root = f"{folder}/{n}"
        scene(root)
        before = listing(root)
        hook, seen = stop_before(n)
        try:
            p.publish(spark, root, moves(spark, root), hook)
        except Stop:
            assert n > 0 or {k: v for k, v in listing(root).items() if not k.startswith("_publication")} == before
            # The next stops in its turn, once, before it comes to an end.
            (journal,) = [f for f in os.listdir(root) if f.endswith(".json")]
            with pytest.raises(Stop):
                p.advance(spark, f"{root}/{journal}", stop_before(0)[0])
            assert p.roll_forward(spark, root) == 1
        else:
            assert len(seen) == n and listing(root) == DONE
            break
        assert listing(root) == DONE
        assert p.roll_forward(spark, root) == 0
        n += 1
    assert n == 8  # dim, d=2 and d=3 go aside; dim, fresh, d=2, d=4 and the audit's file come


def test_a_journal_that_is_not_whole_changes_nothing(spark, folder):
    scene(folder)
    before = listing(folder)
    write(folder, **{"_publication-x.part": '[["'})
    assert p.roll_forward(spark, folder) == 0
    assert listing(folder) == before


def test_stopped_before_old_folders_are_deleted(spark, folder):
    """All is in place, but the journal and what was put aside are still there."""
    scene(folder)
    journal = p.write_journal(spark, folder, moves(spark, folder))
    kept = shutil.copy(journal, f"{folder}/kept")
    p.advance(spark, journal)
    shutil.move(kept, journal)
    write(f"{folder}/core/_old-dim", a="old")
    assert p.roll_forward(spark, folder) == 1
    assert listing(folder) == DONE


def test_what_was_lost_is_told(spark, folder):
    with pytest.raises(FileNotFoundError):
        p.publish(spark, folder, p.whole(f"{folder}/nowhere", f"{folder}/home"))


def two_nights(spark, folder):
    """A full load, and what the next night brings: a new day, a transaction that moved, a new version, a bad row."""
    run_batch(spark, small_source(spark), folder, DAY, TS, full=True)
    changed = small_source(spark)
    changed["FACT_TXN"] = source(spark, "FACT_TXN", [txn("T1", day="20240102"), txn("T7", day="20240102", cust="nobody"), txn("T8", day="20240102")])
    changed["DIM_CUSTOMER"] = changed["DIM_CUSTOMER"].replace("Ann", "Anna", "CUST_NAME") if "CUST_NAME" in changed["DIM_CUSTOMER"].columns else changed["DIM_CUSTOMER"]
    return lambda hook=None: run_batch(spark, changed, folder, NEXT, NEXT_TS, max_unresolved=1.0, before_rename=hook)


def tables(spark, root):
    found = Warehouse(spark, root).tables()
    return {t: dicts(df.drop("seconds")) if t == "batch_audit" else dicts(df) for t, df in found.items()}


def test_a_batch_stopped_before_every_rename(spark, folder, monkeypatch):
    """Over several tables and days: whatever rename it stops at, recovery gives the state of an undisturbed run."""
    root = f"{folder}/house"
    night = two_nights(spark, root)
    copies = []

    def copy_first(session, at, planned, hook=None):
        # The warehouse as it is when all is staged, once for each rename to come.
        copies.extend([planned, shutil.copytree(root, f"{folder}/staged")])
        p.publish(session, at, planned, hook)

    monkeypatch.setattr(batch, "publish", copy_first)
    hook, seen = stop_before(-1)
    night(hook)
    expected, planned = tables(spark, root), copies[0]
    assert len(seen) > 12 and len({os.path.dirname(m.home) for m in planned}) > 3
    for n in range(len(seen)):
        place = shutil.copytree(f"{folder}/staged", f"{folder}/at-{n}")
        here = [p.Move(m.home.replace(root, place), m.staged and m.staged.replace(root, place)) for m in planned]
        with pytest.raises(Stop):
            p.publish(spark, place, here, stop_before(n)[0])
        assert Warehouse(spark, place).recover() == 1
        assert {k for k in listing(f"{place}/core")} == {k for k in listing(f"{root}/core")}
        if n % 5 == 0:
            assert tables(spark, place) == expected


def test_the_next_batch_finishes_the_last(spark, folder):
    night = two_nights(spark, folder)
    with pytest.raises(Stop):
        night(stop_before(3)[0])
    night()
    runs = Warehouse(spark, folder).table("batch_audit").select("run").distinct().count()
    fact = Warehouse(spark, folder).table("fact_transactions")
    assert runs == 3 and dicts(fact, "transaction_bk", "time_sk") == [("T1", 20240102), ("T2", 20240101), ("T3", 20240101), ("T4", 20231231), ("T8", 20240102)]
