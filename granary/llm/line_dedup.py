"""Line dedup: lines that stand on many distinct sites are boilerplate and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import free_name
from granary.session import stage


def line_key(line: Column) -> Column:
    """64-bit hash of a line without the spaces around it."""
    return F.xxhash64(F.trim(line))


def long_enough(line: Column, min_words: int) -> Column:
    return line.rlike(r"\S" + r"\s+\S+" * (min_words - 2) + r"\s+\S" if min_words > 1 else r"\S")


def spread(docs: DataFrame, min_sites: int, min_words: int, lg_k: int = 10, sigmas: float = 4.0,
           id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Lines on at least ``min_sites`` distinct sites, as (key, id) of every document with them but the first.

    A line on that many sites stands in that many places, so counts leave only
    few lines. A HyperLogLog sketch of the sites of each of those is merged by
    aggregation, map side first. A line whose estimate is within ``sigmas``
    standard errors of the threshold gets an exact distinct count; the others are
    decided by the sketch. The document with the smallest id keeps its lines.
    Sites that are null count for nothing, and rows with a null id keep all lines.
    """
    lines = docs.select(F.col(id_col).alias("id"), F.col(site_col).alias("site"), F.explode(F.split(text_col, "\n")).alias("line"))
    lines = lines.where(long_enough(F.col("line"), min_words)).select("id", "site", line_key(F.col("line")).alias("key"))
    often = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("key")
    hits = stage(lines.join(often, "key"), "lines")

    sites = hits.where(F.col("site").isNotNull())
    guess = stage(sites.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites")), "sites")
    room = sigmas * 1.04 / 2 ** (lg_k / 2) * min_sites
    near = guess.where(F.abs(F.col("sites") - min_sites) <= max(1.0, room)).select("key")
    exact = (sites.join(near, "key").groupBy("key", "site").agg(F.lit(1).alias("one"))  # one row a site, so that a hot line is split
             .groupBy("key").agg(F.count("one").alias("sites")).where(F.col("sites") >= min_sites).select("key"))
    spread_out = guess.where(F.col("sites") - min_sites > max(1.0, room)).select("key").unionAll(exact)
    held = hits.join(spread_out, "key").where(F.col("id").isNotNull())
    first = held.groupBy("key").agg(F.min("id").alias("first"))
    return held.join(first, "key").where(F.col("id") != F.col("first")).select("key", "id").distinct()


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, min_words: int = 3, id_col: str = "doc_id",
                       text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``docs`` with cleaned texts, and two columns more: ``lines_before`` and ``lines_removed`` (long).

    Lines are what stands between line feeds; those with fewer than ``min_words``
    words stay. All columns and rows of ``docs`` are kept, empty and null texts
    as they are (a null text has no lines). Of repeated ids each row is cleaned,
    of the lines that any of them loses.
    """
    mine = free_name(docs, "keys")
    gone = stage(spread(docs, min_sites, min_words, id_col=id_col, text_col=text_col, site_col=site_col)
                 .groupBy(F.col("id").alias(id_col)).agg(F.collect_set("key").alias(mine)), "removed")
    lines = F.split(text_col, "\n")
    kept = F.filter(lines, lambda x: ~(F.array_contains(mine, line_key(x)) & long_enough(x, min_words)))
    # Lost lines are a share of the corpus: brought to the texts by a shuffle, at every size alike.
    out = docs.join(gone.hint("merge"), id_col, "left")
    found = F.col(mine).isNotNull()
    columns = [F.when(found, F.array_join(kept, "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*columns, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("lines_before"),
                      F.when(found, F.size(lines) - F.size(kept)).otherwise(0).cast("long").alias("lines_removed"))
