"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import as_bytes, small_batches
from granary.llm.graph import connected_components
from granary.llm.words import word_hashes
from granary.session import stage

PARITY = ("s0", "s1", "s2", "s3")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Distinct hashes of ``width`` words in a row, sorted; A-Z in lower case, words split at ASCII white space.

    A text with fewer words is one shingle; one without words has none.
    """
    coded = word_hashes(text)[0] if text else np.empty(0, np.uint64)
    if not len(coded):
        return coded
    size = min(width, len(coded))
    mixed = np.full(len(coded) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ coded[k:len(coded) - size + 1 + k]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def parity(found: np.ndarray) -> np.ndarray:
    """One bit for each of 256 cells of the hash space: whether a set has an odd number of hashes there, as four numbers."""
    odd = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_digest(found: np.ndarray) -> tuple[int, int]:
    import xxhash

    whole = xxhash.xxh3_128_intdigest(found.tobytes())
    return (whole >> 65), (whole & (1 << 63) - 1)


def prefix_size(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` of which every set similar enough shares one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _required(a: Column, b: Column, percent: int) -> Column:
    """Size that the intersection of two sets must have."""
    return F.floor((percent * (a + b) + 99 + percent) / F.lit(100 + percent))


def token_counts(rows: DataFrame, width: int, bits: int) -> np.ndarray:
    """How many shingles of all texts fall into each of ``2**bits`` hash buckets.

    Each task adds up its own; the result has a fixed size. A shingle that many
    texts share lifts its bucket above the others, and so comes late in the order.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held, n = np.zeros(1 << bits, np.int64), [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append((shingles(text, width) >> np.uint64(64 - bits)).astype(np.int64))
                n += len(held[-1])
                if n >= 1 << bits:  # a count goes through all buckets, so short texts are counted together
                    total += np.bincount(np.concatenate(held), minlength=1 << bits)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    found = rows.select("text").mapInPandas(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << bits, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def signatures(rows: DataFrame, width: int, percent: int, bits: int) -> DataFrame:
    """For each row: id, n, digest of its set, its rarest shingles in order, and parities by cell."""
    counts = rows.sparkSession.sparkContext.broadcast(token_counts(rows, width, bits))

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = counts.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingles(text, width)
                order = np.lexsort((found, common[(found >> np.uint64(64 - bits)).astype(np.int64)]))
                out.append((len(found), *set_digest(found), found[order[:prefix_size(len(found), percent)]].view(np.int64), *parity(found).tolist()))
            made = pd.DataFrame(out, columns=["n", "d1", "d2", "prefix", *PARITY])
            yield made.assign(id=batch["id"].to_numpy())

    return rows.mapInPandas(signed, "id string, n long, d1 long, d2 long, prefix array<long>, " + ", ".join(f"{c} long" for c in PARITY))


def compare(pairs: DataFrame, sets: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Sizes of pairs (a, b) of sets, each pair looked at once: n_a, n_b, both (the intersection), linked, and apart.

    ``apart`` holds the shingles that only one of the two has, if over half of
    all are common, and is null otherwise.
    """
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(sets.select("node", "rep", "d1", "d2"), "node")

    def right(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # an id that stands in several rows may have other sets, too
            same = [set_digest(shingles(t, width)) == (x, y) for t, x, y in zip(batch["text"], batch["d1"], batch["d2"], strict=True)]
            yield batch.loc[np.array(same, bool), ["node", "text"]]

    texts = rows.join(needed.withColumnRenamed("rep", "id"), "id").select("node", "text", "d1", "d2")
    texts = stage(texts.mapInPandas(right, "node long, text binary"), "texts")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = (None, None)
        for batch in batches:
            out = []
            for a, b, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True):
                if last[0] != b:
                    last = (b, shingles(text_b, width))
                one, other = shingles(text_a, width), last[1]
                apart = np.setxor1d(one, other, assume_unique=True)
                both = (len(one) + len(other) - len(apart)) // 2
                out.append((a, b, len(one), len(other), both, 100 * both >= percent * (len(apart) + both), apart.view(np.int64) if both >= len(apart) else None))
            yield pd.DataFrame(out, columns=["a", "b", "n_a", "n_b", "both", "linked", "apart"])

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInPandas(
        compared, "a long, b long, n_a long, n_b long, both long, linked boolean, apart array<long>").dropDuplicates(["a", "b"])


def _possible(percent: int, other: str = "other_") -> Column:
    """Whether two sets may be similar that share a token at ``pos`` and ``other_pos`` of their orders.

    Length filter; prefix filter for this pair, which is as short as both sizes
    allow; positional filter; and the suffix filter: cells in which the two sets
    have different parities differ by a token at least.
    """
    a, b, i, j = F.col("n"), F.col(f"{other}n"), F.col("pos"), F.col(f"{other}pos")
    need = _required(a, b, percent)
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{other}{c}"))) for c in PARITY), F.lit(0))
    return ((100 * F.least(a, b) >= percent * F.greatest(a, b)) & (i <= a - need) & (j <= b - need)
            & (F.least(i, j) + 1 + F.least(a - i - 1, b - j - 1) >= need) & (differ <= a + b - 2 * need))


def _as_other(rows: DataFrame, keep: list[str], rename: list[str]) -> DataFrame:
    return rows.select(*keep, *[F.col(c).alias(f"other_{c}") for c in rename])


def around_pivots(stars: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs among the sets that have half of all shingles in common with the same pivot.

    Two such sets x and y differ from each other just where their differences
    from the pivot differ. If neither component holds both, one of them is
    further from the pivot than any linked set, so that they can only be similar
    if their differences have tokens in common, of which one is among the rarest
    of each. The sets are joined on these. Differences from a pivot are mostly
    those of one set alone, and a group of near copies gives few pairs.
    """
    around = stars.where("apart is not null").select(
        F.col("b").alias("pivot"), F.col("a").alias("node"), F.col("n_a").alias("n"), F.col("n_b").alias("n_pivot"), "linked", "apart")
    around = around.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = around.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("pivot")
    around = stage(around.join(mixed, "pivot").withColumn("d", F.size("apart")), "around")
    tokens = around.select("pivot", "node", F.explode("apart").alias("h"))
    often = tokens.groupBy("pivot", "h").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # What one set alone differs by comes first in its order and joins nothing: only its number counts.
    shared = tokens.join(often, ["pivot", "h"]).join(around.drop("apart"), ["pivot", "node"])
    order = Window.partitionBy("pivot", "node")
    shared = (shared.withColumn("alone", F.col("d") - F.count(F.lit(1)).over(order))
              .withColumn("pos", F.col("alone") + F.row_number().over(order.orderBy("times", "h")) - 1))
    a, d, t = F.col("n"), F.col("d"), percent
    # Least number of tokens in common: with a set that isn't linked to the pivot, and for one that isn't itself with any.
    with_far = F.ceil((d - 1 - F.floor(F.abs(a - F.col("n_pivot")) * (100 - t) / (100 + t))) / 2)
    least = F.when(F.col("linked"), with_far).otherwise(F.least(with_far, d - F.floor(a * (100 - t) / t)))
    shared = stage(shared.where(F.col("pos") <= d - F.greatest(F.lit(1), least)).select("pivot", "h", "node", "n", "d", "pos", "component"), "apart")
    other = _as_other(shared, ["pivot", "h"], ["node", "n", "d", "pos", "component"])
    need = F.ceil((d + F.col("other_d") - (a + F.col("other_n") - 2 * _required(a, F.col("other_n"), percent))) / 2)
    i, j = F.col("pos"), F.col("other_pos")
    return shared.join(other, ["pivot", "h"]).where(
        (F.col("node") > F.col("other_node")) & (F.col("component") != F.col("other_component"))
        & (100 * F.least("n", "other_n") >= t * F.greatest("n", "other_n")) & (i <= d - need) & (j <= F.col("other_d") - need)
        & (F.least(i, j) + 1 + F.least(d - i - 1, F.col("other_d") - j - 1) >= need)).select(
            F.col("node").alias("a"), F.col("other_node").alias("b"))


def links(sets: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between distinct sets that connect just what all links connect, as (a, b).

    Sets are joined on the rarest shingles of each. First, every set is held
    against one pivot under each of its shingles: the set with most company under
    all of its shingles, which the copies of a text are likeliest to be near to.
    That costs a row a shingle. Sets near the same pivot are then joined by where
    they differ from it (``around_pivots``). What is left under a shingle are sets
    that are like its pivot in less than half; each is held against the others
    there. Pairs within one component, and those looked at before, aren't made.
    """
    postings = sets.select("node", F.posexplode("prefix").alias("pos", "h"))
    lists = postings.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(postings.join(lists, "h"), "postings")
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    shared = shared.drop("size").join(company.join(sets.select("node", "n", *PARITY), "node"), "node")
    pivots = shared.groupBy("h").agg(F.max_by("node", F.struct("company", "node")).alias("pivot"))
    shared = stage(shared.drop("company").join(pivots, "h"), "postings")

    about = ["node", "n", "pos", *PARITY]
    middle = _as_other(shared.where(F.col("node") == F.col("pivot")), ["h"], about)
    near = shared.where(F.col("node") != F.col("pivot")).join(middle, "h").where(_possible(percent))
    tested = near.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = stage(compare(stage(tested, "tested"), sets, rows, width, percent), "stars")
    first = stars.where("linked").select("a", "b")
    known = stage(connected_components(first), "known")

    inside = stars.where("apart is not null").select(F.col("a").alias("node"), F.col("b").alias("pivot"), F.lit(True).alias("inside"))
    placed = shared.join(inside, ["node", "pivot"], "left").join(known, "node", "left")
    placed = placed.where(F.col("node") != F.col("pivot")).withColumns(
        {"component": F.coalesce("component", "node"), "inside": F.coalesce("inside", F.lit(False))})
    outside = placed.where(~F.col("inside"))
    placed = stage(placed.join(outside.select("h").distinct(), "h", "left_semi"), "placed")
    other = _as_other(placed, ["h"], [*about, "component", "inside"])
    rest = placed.where(~F.col("inside")).join(other, "h").where(
        (F.col("component") != F.col("other_component")) & (F.col("other_inside") | (F.col("node") > F.col("other_node"))) & _possible(percent))
    more = rest.select(F.greatest("node", "other_node").alias("a"), F.least("node", "other_node").alias("b"))
    more = more.unionAll(around_pivots(stars, known, percent)).distinct()
    done = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more = stage(more.join(done, ["a", "b"], "left_anti"), "more")
    return first.unionAll(compare(more, sets, rows, width, percent).where("linked").select("a", "b"))


def similar_documents(docs: DataFrame, width: int, percent: int, bits: int = 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: id, n_shingles and component, the smallest id reachable by links.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` hundredths or more. A document without words is
    linked with nothing. Equal sets are joined by digest (128 bits) and take part
    once. Rows with the same id are one document: its component is that of any of
    them. A row with a null id has its n_shingles and a null component, and links
    nothing.
    """
    # A row brings two texts and two sets, and what a worker has held once stays with it while the joins run.
    small_batches(docs.sparkSession, 250, "4m")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), as_bytes(text_col).alias("text"))
    signed = stage(signatures(rows, width, percent, bits).withColumn("id", F.col("id").cast(kind)), "signatures")
    rows = rows.withColumn("id", F.col("id").cast(kind))
    linkable = signed.where((F.col("n") > 0) & F.col("id").isNotNull())
    sets = linkable.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix"), *[F.first(c).alias(c) for c in PARITY])
    sets = stage(sets.withColumn("node", F.monotonically_increasing_id()), "sets")

    held = stage(linkable.join(sets.select("d1", "d2", "node"), ["d1", "d2"]).select("id", "node", "n"), "held")
    again = held.groupBy("id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where(F.col("low") != F.col("high"))
    again = held.join(again, "id").where(F.col("node") != F.col("low")).select(F.col("node").alias("a"), F.col("low").alias("b"))
    known = stage(connected_components(links(sets, rows, width, percent).unionAll(again)), "components")

    smallest = known.join(sets.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("smallest"))
    of_node = known.join(smallest, "component").select("node", "smallest")
    of_id = (sets.select("node", "rep").join(of_node, "node", "left").select("node", F.coalesce("smallest", "rep").alias("component"))
             .join(held, "node").groupBy("id").agg(F.min("component").alias("component")))
    out = signed.select("id", "n").join(of_id, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
