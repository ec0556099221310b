import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import ngram_join
from granary.llm.graph import connected_components
from tests.llm.cases import DOCS, awkward, rows_of, with_clashes, words


def brute(docs, width, percent):
    sets, parent = {}, {}
    for doc, text in docs:
        w = (text or "").encode().lower().split()
        sets.setdefault(doc, set()).add(frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
        parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d in ids}, sets


def mixed_docs(seed, n=120):
    """Unrelated texts, exact copies, chains of near copies, and passages that many share."""
    draw, docs = random.Random(seed), []
    passage = words(30, 77)
    for k in range(n):
        kind = draw.random()
        if docs and kind < 0.45:
            text = docs[draw.randrange(len(docs))][1].split()
            for _ in range(draw.randrange(4)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(50)}"
        else:
            text = words(draw.randrange(3, 120), draw.random(), 3000)
            if kind > 0.75:
                text = passage + text
        docs.append((draw.randrange(10**6) * 1000 + k, " ".join(text)))
    return docs


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (1, 50)])
def test_components_as_by_brute_force(spark, width, percent):
    docs = mixed_docs(width)
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    component, sets = brute(docs, width, percent)
    got = {r.doc_id: (r.n_shingles, r.component) for r in ngram_join.similar_documents(frame, width, percent, bits=10).collect()}
    assert got == {i: (len(next(iter(sets[i]))), component[i]) for i, _ in docs}
    assert len(set(component.values())) < len(docs)


def test_links_not_through_the_first_document(spark):
    """b and c link, and so do c and d, but a is like none of them; all share rare words."""
    base = [f"r{k}" for k in range(60)]
    near = [base[:], base[:], base[:]]
    near[1][5], near[2][5], near[2][40] = "y", "y", "z"
    docs = [(1, " ".join(base[:30] + [f"q{k}" for k in range(30)]))] + [(k + 2, " ".join(t)) for k, t in enumerate(near)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    got = {r.doc_id: r.component for r in ngram_join.similar_documents(frame, 4, 85).collect()}
    assert got == brute(docs, 4, 85)[0]


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(ngram_join.similar_documents(with_clashes(docs), 4, 85))
    by = defaultdict(set)
    for doc, n, component in got:
        by[doc].add((n, component))
    assert by[1] == by[2] == {(77, 1)} and by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert by[7] == {(1, 7)} and len(got) == docs.count() and by[None] == {(77, None)}
    assert rows_of(ngram_join.similar_documents(docs, 4, 85)) == got


def test_no_rows(spark):
    assert ngram_join.similar_documents(spark.createDataFrame([], DOCS), 4, 85).collect() == []


def test_components_of_a_path_and_a_star(spark):
    draw = random.Random(3)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(1, 60)]
    edges = [(b, a) if draw.random() < 0.5 else (a, b) for a, b in path + star] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 1 for k in [*range(1, 60), 500]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).collect() == []


def test_shingles_are_counted_text_by_text_and_together(spark):
    """Short texts share a count; the counts are those of each by itself, and texts reach the workers in small batches."""
    docs = spark.createDataFrame(mixed_docs(5, 300) + [(1000, None), (1001, "")], "doc_id long, text string").select(F.col("text").cast("binary").alias("text"))
    found = ngram_join.token_counts(docs, 4, 6)
    wanted = sum(np.bincount((ngram_join.shingles(bytes(r.text) if r.text else None, 4) >> np.uint64(58)).astype(np.int64), minlength=64) for r in docs.collect())
    assert found.tolist() == wanted.tolist() and found.sum() > 64
    ngram_join.similar_documents(spark.createDataFrame(mixed_docs(6, 20), "doc_id long, text string"), 4, 85)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "250"
