import math
import zlib
from collections import Counter

import numpy as np
import pytest

from granary.llm import queries, recurrent_lm
from granary.llm.recurrent_lm import Shape, initial, lanes, output, score, train
from tests.llm.cases import awkward, with_clashes


@pytest.fixture(scope="module")
def small():
    shape = Shape(hidden=4, words=8, in_class=4, tails=3)
    words = np.array([5, 4, 3, 2, 2, 1, 1, 1])
    p = initial(shape, np.r_[words.reshape(2, 4).sum(axis=1), [3, 2, 1]], words)
    draw = np.random.default_rng(0)
    return shape, {k: (v + draw.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in p.items()}


def test_probabilities_add_up(small):
    shape, p = small
    h = np.random.default_rng(1).normal(size=(1, 4))
    assert math.isclose(sum(math.exp(output(shape, p, h, np.array([k]))[0][0]) for k in range(11)), 1, rel_tol=1e-6)


def test_gradients_as_by_differences(small):
    shape, p = small
    p = {k: v.astype(float) for k, v in p.items()}
    draw = np.random.default_rng(2)
    h, target = draw.normal(size=(6, 4)), np.array([0, 3, 5, 8, 9, 7])
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    _, dh = output(shape, p, h, target, grads)
    for name in ("c", "cb", "w", "wb"):
        at = np.unravel_index(3, p[name].shape)
        loss = []
        for step in (1e-5, -2e-5):
            p[name][at] += step
            loss.append(-output(shape, p, h, target)[0].sum())
        p[name][at] += 1e-5
        assert math.isclose((loss[0] - loss[1]) / 2e-5, grads[name][at], rel_tol=1e-4, abs_tol=1e-7)
    loss = []
    for step in (1e-5, -2e-5):
        h[1, 2] += step
        loss.append(-output(shape, p, h, target)[0].sum())
    assert math.isclose((loss[0] - loss[1]) / 2e-5, dh[1, 2], rel_tol=1e-4)


def test_state_goes_on_between_windows(small):
    shape, p = small
    draw = np.random.default_rng(3)
    docs = [draw.integers(0, 11, n).astype(np.int32) for n in (1, 7, 200, 3, 50, 90)]
    alone = [score(shape, p, [d], window=1000)[0] for d in docs]
    assert np.allclose(score(shape, p, docs, width=3, window=16), alone, atol=1e-3)
    given, wanted, owner, load = lanes(docs, 3, 11)
    assert sorted(wanted[wanted >= 0].tolist()) == sorted(np.concatenate(docs).tolist()) and (np.diff(load) <= 0).all()
    assert (given[(owner >= 0)] >= 0).all()


def test_training_learns_an_order(small):
    shape, p = small
    docs = [np.array([1, 2, 3, 4, 5, 6, 7, 0] * 10, np.int32) for _ in range(20)]
    learned = train(shape, p, docs, 300, 0.02, width=8)
    assert score(shape, learned, docs).mean() > 0.3 * score(shape, p, docs).mean()


def brute(docs):
    counts, end = Counter(), ("end",)
    for d in docs:
        if d.doc_id is None or zlib.crc32(str(d.doc_id).encode()) % 7 != 2:
            counts.update((d.text or "").encode().lower().split())
            counts[end] += 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d in docs:
        words = [*(d.text or "").encode().lower().split(), end]
        out.setdefault(d.doc_id, []).append((len(words), sum(counts[w] > 0 for w in words), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return out


def check(got, docs):
    expected = brute(docs)
    assert len(got) == len(docs)
    for r in got:
        assert any((r.n_tokens, r.n_known, r.train_tokens) == e[:3] and math.isclose(r.base_score, e[3], rel_tol=1e-9) for e in expected[r.doc_id])
        assert r.score < 0 and math.isfinite(r.score)


def test_whole_table(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").collect()
    got = queries.op10_recurrent_lm(spark, larger).collect()
    check(got, docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_joined(spark, sf_dir):
    """With a short list most words go through the join; base scores are the same."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shape = Shape(hidden=4, words=64, in_class=8, tails=4)
    check(recurrent_lm.score_documents(docs, shape=shape, listed=100, rounds=1, updates=5, shards=2).collect(), docs.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    shape = Shape(hidden=4, words=64, in_class=8, tails=4)
    check(recurrent_lm.score_documents(with_clashes(docs), shape=shape, rounds=1, updates=3, shards=2).collect(), docs.collect())
    assert recurrent_lm.score_documents(docs.limit(0), shape=shape, rounds=1, updates=3, shards=2).collect() == []


def test_training_reads_every_token(small):
    """The tail of one very long text and the last texts of long lanes give a gradient, too."""
    shape, p = small
    docs = [np.array([1, 2, 0] * 5, np.int32) for _ in range(9)] + [np.array([1, 2] * 300 + [6, 7, 0], np.int32)]
    for given in (docs, iter(docs)):
        learned = train(shape, p, given, 1, 0.02, width=4, window=8)
        assert all((learned["x"][k] != p["x"][k]).any() for k in (1, 2, 6, 7))
    laid = [(g[g >= 0].tolist(), w[w >= 0].tolist()) for g, w, _ in recurrent_lm.flow(docs, 4, 8, 11)]
    assert sorted(k for _, w in laid for k in w) == sorted(np.concatenate(docs).tolist())
    assert sum(g.count(11) for g, _ in laid) == len(docs)


def test_shards_grow_with_the_tokens(small):
    shape, p = small
    for tokens in (1, 10**6, 10**8, 5 * 10**9):
        parts, shards = recurrent_lm.shards_for(tokens, 6, 4, 4_000_000)
        assert parts in (1, 4) and shards >= 6 and parts * shards * 4_000_000 >= tokens
    docs = [np.array([1, 2, 0] * 50, np.int32) for _ in range(40)]
    assert recurrent_lm.train_shard(shape, p, iter(docs), 3, 0.01, 0, ahead=1000)[1] == 6000  # far more than is held


def test_weights_are_averaged_by_tokens(spark):
    """In steps of three shards a task, down to one row; also of no shards."""
    draw = np.random.default_rng(4)
    rows = [(k, int(draw.integers(1, 99)), draw.normal(size=5).astype(np.float32)) for k in range(23)]
    made = spark.createDataFrame([(k, n, w.tobytes()) for k, n, w in rows], "shard int, tokens long, weights binary")
    total, mean = recurrent_lm.mean_weights(made, 23, fan=3)
    assert total == sum(n for _, n, _ in rows)
    assert np.allclose(mean, sum(n * w.astype(float) for _, n, w in rows) / total)
    assert recurrent_lm.mean_weights(made.limit(0), 1) == (0, None)


def test_scores_as_by_a_plain_loop(small):
    """Every word's probability by the defining formulas, one word after the other."""
    shape, p = small
    draw = np.random.default_rng(5)
    docs = [draw.integers(0, 11, n).astype(np.int32) for n in (0, 1, 9, 40)]

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def share(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    for doc, got in zip(docs, score(shape, p, docs, width=2, window=4), strict=True):
        h, before, total = np.zeros(4), 11, 0.0
        for word in doc:
            x, u = p["x"][before].astype(float), p["u"].astype(float)
            z = sig(x[:4] + h @ u[:, :4])
            r = sig(x[4:8] + h @ u[:, 4:8])
            n = np.tanh(x[8:] + r * (h @ u[:, 8:]))
            h = (1 - z) * n + z * h
            group = word // 4 if word < 8 else word - 8 + 2
            total += math.log(share(h @ p["c"] + p["cb"])[group])
            if word < 8:
                total += math.log(share(h @ p["w"][group] + p["wb"][group])[word % 4])
            before = word
        assert math.isclose(got, total, rel_tol=1e-4, abs_tol=1e-4)


def test_a_long_text_holds_up_no_other(small):
    """Short texts are scored and given while a long one still goes on; each as if it were alone."""
    shape, p = small
    draw = np.random.default_rng(6)
    docs = [draw.integers(0, 11, n).astype(np.int32) for n in (900, *[10] * 60, 0, 25)]
    taken = []
    got = list(recurrent_lm.score_flow(shape, p, (taken.append(k) or d for k, d in enumerate(docs)), width=4, window=8))
    assert sorted(k for k, _ in got) == list(range(len(docs)))
    assert [k for k, _ in got].index(0) > 55
    steps = []
    plain, recurrent_lm._step = recurrent_lm._step, lambda *a: steps.append(1) or plain(*a)
    try:
        for k, found in got:
            assert math.isclose(found, score(shape, p, [docs[k]])[0], rel_tol=1e-5, abs_tol=1e-5)
        steps.clear()
        list(recurrent_lm.score_flow(shape, p, [np.ones(100, np.int32), *[np.ones(10, np.int32)] * 10] * 9, width=9, window=10))
    finally:
        recurrent_lm._step = plain
    assert len(steps) <= 300


def test_far_apart_logits_are_shifted(small):
    """Where exp of the logits would overflow or vanish, the largest is taken off first; either way the same."""
    shape, p = small
    assert recurrent_lm._spread(p["c"], p["cb"]) and recurrent_lm._spread(p["w"], p["wb"])
    h, target = np.random.default_rng(7).normal(size=(11, 4)).clip(-1, 1).astype(np.float32), np.arange(11)
    expected = output(shape, p, h, target)[0]
    for shift in (-500, 500):
        moved = {k: v + np.float32(shift) if k in ("cb", "wb") else v for k, v in p.items()}
        assert not recurrent_lm._spread(moved["c"], moved["cb"])
        assert np.allclose(output(shape, moved, h, target)[0], expected, atol=1e-3)


def test_texts_are_coded_once(spark, monkeypatch):
    """Training and scoring read the codes that were written, not the texts again."""
    seen, write = {}, recurrent_lm.stage

    def noted(df, name):
        seen[name] = df._jdf.queryExecution().analyzed().toString()
        return write(df, name)

    monkeypatch.setattr(recurrent_lm, "stage", noted)
    shape = Shape(hidden=4, words=64, in_class=8, tails=4)
    docs = spark.createDataFrame([(k, f"a b c d{k}") for k in range(20)], "doc_id long, text string")
    check(recurrent_lm.score_documents(docs, shape=shape, rounds=1, updates=3, shards=2).collect(), docs.collect())
    assert "text" in seen["codes"] and not any("text" in seen[k] for k in ("weights", "scored"))


def test_words_of_any_length_have_their_tail(spark):
    shape = Shape(hidden=4, words=64, in_class=8, tails=48)
    words = ["a", "bc", "def", "é", "xy€", "x" * 300]
    got = recurrent_lm.count_tokens(spark.createDataFrame([(" ".join(words).encode(),)], "text binary"), shape).collect()
    assert {(bytes(r.word), r.tail, r.c) for r in got} == {(w.encode(), shape.tail(w.encode()), 1) for w in words}
    assert all(recurrent_lm.Tails(shape)[w.encode()[-2:]] == shape.words + shape.tail(w.encode()) for w in words)
