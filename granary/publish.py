"""Publishing staged folders: all of them, also after a stop.

What is to be renamed is written to a journal first, a small file beside the
tables. Until the journal is there nothing has changed; from then on the
publication goes forward: :func:`roll_forward` does what is still to be done,
and doing it twice does no harm. One writer at a time is assumed, as it is by
the batch. Each folder is away for a moment between two renames; a copy takes
the place of a rename on object stores.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from granary.session import hadoop, hadoop_path

_ASIDE = "_old-"
_JOURNAL = "_publication-"


@dataclass(frozen=True)
class Move:
    """What is ``staged`` goes to ``home``, in place of what is there; with nothing staged, that only goes."""

    home: str
    staged: str | None = None


def whole(staged: str, path: str) -> list[Move]:
    """A staged table in place of a table."""
    return [Move(path, staged)]


def by_folder(spark: SparkSession, staged: str, path: str, emptied: Iterable[str] = ()) -> list[Move]:
    """Staged partition folders in place of those of the same name, and the ``emptied`` ones away."""
    return [Move(f"{path}/{name}", f"{staged}/{name}") for name in folder_names(spark, staged) if "=" in name] + [Move(f"{path}/{name}") for name in emptied]


def added_files(spark: SparkSession, staged: str, path: str) -> list[Move]:
    """Files of staged partition folders beside those that the table has; their names are unique."""
    return [
        Move(f"{path}/{folder}/{name}", f"{staged}/{folder}/{name}")
        for folder in folder_names(spark, staged) if "=" in folder
        for name in folder_names(spark, f"{staged}/{folder}") if not name.startswith(("_", "."))
    ]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it isn't there."""
    files, place = hadoop(spark, path)
    if not files.exists(place):
        return []
    jvm = spark.sparkContext._jvm  # one call for all names: a fact has a folder a day
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(place))
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\n")
    return sorted(p.rpartition("/")[2] for p in names.split("\n") if p)


def write_journal(spark: SparkSession, root: str, moves: list[Move]) -> str:
    """Write down ``moves`` under ``root``; the journal is whole or absent."""
    name = f"{root}/{_JOURNAL}{uuid.uuid4().hex}"
    files, started = hadoop(spark, f"{name}.part")
    out = files.create(started)
    out.write(bytearray(json.dumps([[m.home, m.staged] for m in moves]).encode()))
    out.close()
    _, place = hadoop(spark, f"{name}.json")
    if not files.rename(started, place):
        raise OSError(f"{started} can't be renamed")
    return f"{name}.json"


def advance(spark: SparkSession, journal: str, before_rename: Callable[[str, str], None] | None = None) -> None:
    """Do what a journal says as far as it isn't done, then delete it with the old folders.

    ``before_rename`` is called with the source and target of each rename, for
    instance to log it; if it raises, the publication stops there.
    """
    files, place = hadoop(spark, journal)
    stream = files.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()

    def path(name: str):
        return hadoop_path(spark, name)

    def rename(source: str, target: str) -> None:
        if before_rename:
            before_rename(source, target)
        files.mkdirs(path(target).getParent())
        if not files.rename(path(source), path(target)):
            raise OSError(f"{source} can't be renamed to {target}")

    moves = [Move(*m) for m in json.loads(text)]
    for m in moves:
        waits = m.staged is not None and files.exists(path(m.staged))
        if (waits or m.staged is None) and files.exists(path(m.home)):
            # An old folder beside one in place is of no use to anyone.
            files.delete(path(_aside(m.home)), True)
            rename(m.home, _aside(m.home))
        if waits:
            rename(m.staged, m.home)
        elif m.staged is not None and not files.exists(path(m.home)):
            raise FileNotFoundError(f"neither {m.staged} nor {m.home} is there")
    for m in moves:
        files.delete(path(_aside(m.home)), True)
    files.delete(place, False)


def _aside(home: str) -> str:
    parent, _, name = home.rpartition("/")
    return f"{parent}/{_ASIDE}{name}"


def publish(spark: SparkSession, root: str, moves: list[Move], before_rename: Callable[[str, str], None] | None = None) -> None:
    """Make all ``moves``; if this is stopped after its journal is written, :func:`roll_forward` makes the rest."""
    roll_forward(spark, root)
    if moves:
        advance(spark, write_journal(spark, root, moves), before_rename)


def roll_forward(spark: SparkSession, root: str) -> int:
    """Finish the publications that were stopped under ``root``; how many there were.

    A journal that was not finished itself is deleted: nothing was renamed yet.
    """
    files, _ = hadoop(spark, root)
    found = [n for n in folder_names(spark, root) if n.startswith(_JOURNAL)]
    for name in found:
        if name.endswith(".json"):
            advance(spark, f"{root}/{name}")
        else:
            files.delete(hadoop(spark, f"{root}/{name}")[1], False)
    return sum(name.endswith(".json") for name in found)


def put_in_place(spark: SparkSession, staged: str, path: str, partitions: bool = False, emptied: Iterable[str] = ()) -> None:
    """Publish one table: as the whole of ``path``, or with ``partitions`` folder by folder.

    ``staged`` has to outlast a stop, so it belongs beside the table and not
    into a session's scratch folder. The journal is written beside the table, too.
    """
    moves = by_folder(spark, staged, path, emptied) if partitions else whole(staged, path)
    publish(spark, path.rpartition("/")[0], moves)
    files, place = hadoop(spark, staged)
    files.delete(place, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what was stopped at a table: its journal, or else an old folder comes back where no new one stands."""
    path = path.rstrip("/")
    parent, _, own = path.rpartition("/")
    roll_forward(spark, parent)
    files, _ = hadoop(spark, path)
    for folder, wanted in ((parent, lambda name: name == _ASIDE + own), (path, lambda name: name.startswith(_ASIDE))):
        for name in filter(wanted, folder_names(spark, folder)):
            old, home = (hadoop(spark, f"{folder}/{n}")[1] for n in (name, name.removeprefix(_ASIDE)))
            if files.exists(home):
                files.delete(old, True)
            elif not files.rename(old, home):
                raise OSError(f"{old} can't be renamed to {home}")
