from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.cases import DOCS, awkward, rows_of
from tests.llm.test_ngram_join import brute


def test_stages_one_by_one(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    columns, benchmark = docs.columns, [r.text for r in spark.read.parquet(f"{larger}/benchmark.parquet").collect()]
    state, seen = docs, []
    for name, apply in corpus_pipeline.STAGES:
        before, state = state, corpus_pipeline.stage(apply(spark, state, larger), "stage")
        seen.append(name)
        if len(seen) < len(corpus_pipeline.STAGES):
            assert state.columns == columns and state.count() <= before.count()
        old, new = ({r.doc_id: r.text for r in x.collect()} if "text" in x.columns else None for x in (before, state))
        if seen[-1] == "toxicity":
            assert 0 < len(old) - len(new) < 0.2 * len(old)
        if seen[-1] == "line dedup":
            lines = Counter((s, x.strip(" ")) for r in state.collect() for s, x in {(r.source, x) for x in r.text.split("\n") if len(x.split()) > 2})
            assert max(Counter(x for _, x in lines).values()) < 10
        if seen[-1] == "n-gram Jaccard join":
            component, _ = brute(list(old.items()), 5, 80)
            assert set(new) == {d for d in old if component[d] == d}
        if seen[-1] == "benchmark decontamination":
            assert set(new) == {d for d, t in old.items() if not any(b in t for b in benchmark)}
        if seen[-1] == "best-fit packing":
            assert {r.doc_id for r in state.select("doc_id").distinct().collect()} == set(old)
    whole = corpus_pipeline.run(spark, larger)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(whole.select(columns)) == rows_of(state.select(columns))


def apply_all(spark, docs, sf_dir):
    for name, apply in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(apply(spark, docs, sf_dir), "stage")
        if name != "best-fit packing":
            assert docs.columns == before.columns
    return docs


def test_awkward_rows_with_clashing_columns(spark, sf_dir):
    names = ("lines_removed", "lines_before", "aside_lines_before", "__id", "__score", "__row", "__keys", "id", "keys", "row", "_row", "score", "copy", "key", "item", "place")
    docs = awkward(spark).selectExpr("*", *[f"n_chars as {name}" for name in names])
    # Copies 1 and 2 and the repeated row 7 are one document each; the rest stays, the null id too.
    assert sorted({r.doc_id for r in apply_all(spark, docs, sf_dir).collect()}, key=str) == [1, 3, 4, 5, 6, 7, 8, None]


def test_empty_table(spark, sf_dir):
    assert apply_all(spark, spark.createDataFrame([], DOCS), sf_dir).collect() == []


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert len(names) == 13 and "pipeline" in entry.queries()
