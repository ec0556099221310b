import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from granary.llm import fertility
from granary.llm.vocabularies import byte_bpe, piece_bpe, vocabulary_path
from tests.llm.cases import DOCS, awkward, with_clashes, words


def brute(text):
    words = text.encode().split() if text else []
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_whole_table(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    got = {r.doc_id: r for r in fertility.judge(docs).collect()}
    count, pieces = byte_bpe(vocabulary_path("byte_bpe_50k.tiktoken")), piece_bpe(vocabulary_path("piece_bpe_32k.model"))
    for k, d in enumerate(docs.orderBy("doc_id").collect()):
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(d.text)
        assert not (r.base_failed and r.kept)
        if k % 25 == 0:
            parts = d.text.encode().split()
            ids = Counter(x for p, _ in pieces(parts) for x in memoryview(p).cast("I"))
            total = sum(ids.values())
            assert math.isclose(r.chars_per_token, r.word_chars / sum(count(parts)))
            assert math.isclose(r.token_entropy, -sum(v / total * math.log2(v / total) for v in ids.values()), abs_tol=1e-9)
            assert math.isclose(r.fallback_share, sum(s for _, s in pieces(parts)) / total)
    # Junk goes and clean text stays, as the labels have it, which no measure or band has seen.
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    sound = {q: [r.kept for r in got.values() if not r.base_failed and label.get(r.doc_id) == q] for q in (0, 1)}
    assert len(sound[0]) > 20 and sum(sound[0]) < 0.25 * len(sound[0])
    assert len(sound[1]) > 200 and sum(sound[1]) > 0.98 * len(sound[1])


def test_entropy_gap_is_that_to_a_parabola(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    rows = [r for r in fertility.judge(docs).join(docs.select("doc_id", "lang"), "doc_id").collect() if not r.base_failed]
    for lang in {r.lang for r in rows}:
        own = [r for r in rows if r.lang == lang]
        x, y = np.log2([r.word_chars / r.chars_per_token for r in own]), np.array([r.token_entropy for r in own])
        gap = y - np.polyval(np.polyfit(x, y, 2), x)
        assert np.abs(gap - [r.entropy_gap for r in own]).max() < 1e-6
        low, high = np.quantile(gap, [0.25, 0.75])
        inside = (gap >= low - 3.1 * (high - low)) & (gap <= high + 3.1 * (high - low))
        assert not any(r.kept for r, ok in zip(own, inside, strict=True) if not ok)


def test_texts_outside_their_band(spark):
    draw = [" ".join(words(100, k, 5000)) for k in range(60)]
    odd = " ".join("ᚠᚢᚦᚨᚱᚲ" + chr(0x16A0 + k % 60) + chr(0x16A0 + k // 60) for k in range(300))  # byte fallback throughout
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate([*draw, odd])], DOCS)
    got = {r.doc_id: r for r in fertility.judge(docs).collect()}
    assert not got[60].kept and not got[60].base_failed and got[60].fallback_share > 0.5
    assert all(got[k].kept for k in range(60) if not got[k].base_failed)


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    got = fertility.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in (3, 4, 5):
            assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)
    assert fertility.judge(docs.limit(0).withColumn("lang", F.lit(None).cast("string"))).collect() == []
