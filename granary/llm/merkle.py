"""Merkle manifest of a table: trees of hashes with a witness for every row, built by appending."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import stage

FAN = 16
#: Levels that one block of nodes is closed to; a block has FAN ** LEVELS nodes.
LEVELS = 2
WITNESS = "array<struct<before: string, after: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Run:
    """Siblings so far; ``up`` is the place of their parent, once they are complete."""

    digests: list[str] = field(default_factory=list)
    up: tuple[Run, int] | None = None
    text: str | None = None

    def whole(self) -> str:
        if self.text is None or len(self.text) != 64 * len(self.digests):
            self.text = "".join(self.digests)
        return self.text


class Appender:
    """A tree that nodes are appended to, with a witness of each node at any time.

    Each level has one open run. A node's witness begins with its place in the
    open run; the run is shared, so every sibling that is completed later extends
    the witnesses of all nodes below the others at once. A full run's hash is
    appended to the level above, which extends them by a level. Subtrees stay
    aligned: the k-th node stands in the run k // fan. The nodes may themselves
    be roots of blocks that other tasks built.
    """

    def __init__(self, fan: int = FAN):
        self.fan, self.open = fan, [Run()]

    def append(self, node: str, level: int = 0) -> tuple[Run, int]:
        """Add a node; what it gives back is good for :meth:`witness` now and later."""
        if level == len(self.open):
            self.open.append(Run())
        run = self.open[level]
        run.digests.append(node)
        place = (run, len(run.digests) - 1)
        if len(run.digests) == self.fan:
            self._complete(level)
        return place

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], Run()
        run.up = self.append(digest(run.whole()), level + 1)

    def close(self, levels: int) -> str:
        """Complete the open runs below ``levels``, shorter ones too, and give the one node that is there."""
        for level in range(levels):
            if self.open[level].digests:
                self._complete(level)
        last = self.open[levels].digests if levels < len(self.open) else []
        if len(last) != 1:
            raise ValueError(f"{len(last)} nodes at level {levels}, not one")
        return last[0]

    @staticmethod
    def witness(place: tuple[Run, int], levels: int | None = None) -> list[tuple[str, str]]:
        """The siblings before and after, level by level, as far as they are known (or for so many levels)."""
        out: list[tuple[str, str]] = []
        step: tuple[Run, int] | None = place
        while step is not None and (levels is None or len(out) < levels):
            run, k = step
            out.append((run.whole()[:64 * k], run.whole()[64 * (k + 1):]))
            step = run.up
        return out


def height(nodes: int, fan: int = FAN) -> int:
    """Levels above ``nodes`` nodes until one remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fan), levels + 1
    return levels


def value(field: Column) -> Column:
    """A field of a leaf: ``-`` for null, else the number of its bytes, ``:`` and itself; integers are decimal."""
    text = field.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    """The hash of a row's fields, one after the other."""
    return F.sha2(F.concat(*map(value, fields)), 256)


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``at``, the place of each in its group from 0 on, and ``total``; and each group with its total.

    Rows are sorted by ranges, which cut large groups too: no group is brought
    together. Places are those in the range, moved by the rows of the group in
    earlier ranges, which there are as many numbers for as ranges.
    """
    keys = [group, *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    ordered = stage(ordered, name).withColumn("part", F.shiftright("place", 33))
    counts = ordered.groupBy("part", group).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    whole = Window.partitionBy(group)
    counts = stage(counts.withColumn("total", F.sum("n").over(whole)).withColumn("earlier", F.sum("n").over(whole.orderBy("part")) - F.col("n")), f"{name}-counts")
    b = counts.withColumnsRenamed({group: "its_group", "part": "its_part"})
    joined = ordered.join(b, (F.col("part") == F.col("its_part")) & F.col(group).eqNullSafe(F.col("its_group")))
    placed = joined.withColumn("at", F.col("place") - F.col("first") + F.col("earlier")).select(*rows.columns, "at", "total")
    return placed, counts.select(group, "total").distinct()


def _appended(nodes: pa.Table, fan: int, levels: int) -> tuple[Appender, list, int]:
    nodes = nodes.sort_by("at")
    up, tree = min(levels, height(nodes["total"][0].as_py(), fan)), Appender(fan)
    return tree, [tree.append(n) for n in nodes["node"].to_pylist()], up


def raised(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """The roots of all blocks of (tree, at, node, total), as nodes of the same kind."""
    size = fan ** levels

    def root(block: pa.Table) -> pa.Table:
        tree, _, up = _appended(block, fan, levels)
        first = block.slice(0, 1)
        return pa.table({"tree": first["tree"], "at": pa.array([first["at"][0].as_py() // size]), "node": pa.array([tree.close(up)]),
                         "total": pa.array([-(-first["total"][0].as_py() // size)])})

    blocks = nodes.select("tree", "at", "node", "total", F.expr(f"at div {size}").alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(root, "tree long, at long, node string, total long")


def lowered(nodes: DataFrame, above: DataFrame, shared: list[str], fan: int, levels: int) -> DataFrame:
    """``nodes`` with the ``shared`` columns and the ``witness``: that within their block, extended by that of its root in ``above``."""
    size, kept = fan ** levels, nodes.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields] + [f"{c} string" for c in shared] + [f"witness {WITNESS}"])

    def witnesses(block: pa.Table, root: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        tree, places, up = _appended(block, fan, levels)
        tree.close(up)
        rest = [(w["before"], w["after"]) for w in root["witness"][0].as_py()]
        found = [w for p in places for w in tree.witness(p, up) + rest]
        pairs = pa.StructArray.from_arrays([pa.array([before for before, _ in found], pa.string()), pa.array([after for _, after in found], pa.string())], ["before", "after"])
        ends = pa.array([k * (up + len(rest)) for k in range(len(places) + 1)], pa.int32())
        again = [pa.array([root[c][0].as_py()] * len(places), pa.string()) for c in shared]
        return pa.table([*[block[c] for c in kept], *again, pa.ListArray.from_arrays(ends, pairs)], names=[*kept, *shared, "witness"])

    blocks = nodes.withColumn("block", F.expr(f"at div {size}")).groupBy("tree", "block")
    roots = above.select("tree", F.col("at").alias("block"), *shared, "witness").groupBy("tree", "block")
    return blocks.cogroup(roots).applyInArrow(witnesses, schema)


def climbed(nodes: DataFrame, most: int, fan: int, levels: int) -> list[DataFrame]:
    """``nodes``, the roots of their blocks, those of the blocks of these and so on, until each tree has one node."""
    rounds = [nodes]
    while most > 1:
        rounds.append(stage(raised(rounds[-1], fan, levels), "block-roots"))
        most = -(-most // fan ** levels)
    return rounds


def with_witnesses(rows: DataFrame, group: str, order: list[str], node: str, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Rows with ``subroot`` of their group's tree, ``root`` of all and their ``witness`` up to the root.

    Trees are built from blocks of fan ** levels nodes. The roots of a level of
    blocks are appended to the next, as many rounds as the largest group needs;
    the subroots, in the groups' order, are the leaves of one more such tree.
    Witnesses are built the same way down: each block appends its nodes again and
    extends their witnesses by that of its root, so that those of leaves are
    never stored.
    """
    placed, totals = ranked(rows, group, order, "leaves")
    groups, _ = ranked(totals.withColumnRenamed("total", "leaves").withColumn("all", F.lit(0)), "all", [group], "groups")
    numbers = stage(groups.select(F.col(group).alias("its_group"), F.col("at").alias("tree"), "leaves"), "trees")
    size = numbers.agg(F.count("*").alias("n"), F.max("leaves").alias("most")).first()
    leaves = stage(placed.join(numbers.drop("leaves"), F.col(group).eqNullSafe(F.col("its_group"))).drop("its_group").withColumn("node", F.col(node)), "places")
    trees = climbed(leaves, size.most or 0, fan, levels)
    subroots = trees[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), "node", F.lit(size.n).cast("long").alias("total"))
    top = climbed(subroots, size.n, fan, levels)
    found = top[-1].select("tree", "at", "node", F.col("node").alias("root"), F.array().cast(WITNESS).alias("witness"))
    for nodes in reversed(top[:-1]):
        found = lowered(nodes, found, ["root"], fan, levels)
    # The one node left of a tree is a leaf of the tree of all groups.
    found = stage(found.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("node").alias("subroot"), "root", "witness"), "subroots")
    for nodes in reversed(trees[1:-1]):
        found = stage(lowered(nodes, found, ["subroot", "root"], fan, levels).select("tree", "at", "subroot", "root", "witness"), "witnesses")
    whole = lowered(leaves, found, ["subroot", "root"], fan, levels) if len(trees) > 1 else leaves.join(found.drop("at"), "tree")
    return whole.drop("tree", "node", "at", "total")


def proof(witness: Column) -> Column:
    """The hash of all siblings of a witness, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda w: F.concat(w.before, w.after)), ""), 256)


def folded(node: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(witness, node, lambda h, w: F.sha2(F.concat(w.before, h, w.after), 256))


def manifest(docs: DataFrame, columns: list[str], group: str, order: str, more: dict[str, Column] | None = None) -> DataFrame:
    """(``order`` column, leaf, subroot, root, witness) of every row of ``docs``, and ``more`` columns made from it.

    A leaf is the hash of ``columns``; a null field differs from an empty one.
    There is a tree for each value of ``group``, null being one, whose leaves
    ascend by ``order``, nulls first, and where that is equal by hash: repeated
    rows are leaves of their own. An empty table has no rows and no root. Other
    columns are not looked at, texts may be of any length.
    """
    more = more or {}
    own = [F.col(order).alias("row_id"), F.col(group).alias("row_group"), leaf([F.col(c) for c in columns]).alias("leaf")]
    rows = stage(docs.select(*own, *[c.alias(f"more_{name}") for name, c in more.items()]), "hashes")
    found = with_witnesses(rows.withColumn("tie", F.monotonically_increasing_id()), "row_group", ["row_id", "leaf", "tie"], "leaf")
    return found.select(F.col("row_id").alias(order), "leaf", "subroot", "root", "witness", *[F.col(f"more_{name}").alias(name) for name in more])
