"""Language, quality and toxicity: accuracy on held-out rows, and awkward rows."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from granary.llm import language_id, quality_ranking, queries, toxicity
from granary.llm.common import as_bytes, in_bucket
from tests.llm.cases import DOCS, awkward, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def area(label, score):
    label, score = np.array(label), np.array(score)
    return (score[label == 1][:, None] > score[label == 0][None, :]).mean() + 0.5 * (score[label == 1][:, None] == score[label == 0][None, :]).mean()


def held_out(spark, sf_dir, query, label):
    found = query(spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{label} is not null"), "doc_id").collect()
    return [r[label] for r in found], found


def test_language_of_held_out_documents(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    found = queries.op2_language_id(spark, larger).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_language_scores_as_by_a_loop(spark):
    texts = [("de", "der die und das"), ("en", "the and of it"), ("en", "this is the one"), ("de", None), (None, "x")]
    docs = spark.createDataFrame([(k, t, g, "s", 0) for k, (g, t) in enumerate(texts)], DOCS)
    model = language_id.fit(docs)
    assert model.languages == ["de", "en"]
    text = "The der ÄÖ 3" * 40
    expected = model.log_prior.copy()
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    for found in language_id.gram_buckets(codes, model.orders, model.bits):
        expected += model.log_prob[:, found].astype(float).sum(axis=1)
    share = np.exp(expected - expected.max())
    for size in (7, 50, 10_000):  # blocks of any size
        (name, other), score = language_id.score_texts([text, "of"], model, size)
        assert name == model.languages[int(expected.argmax())] and abs(score[0] - 1 / share.sum()) < 1e-6
        assert other == "en"


def test_language_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    model = language_id.fit(docs)
    got = {r.doc_id: r.p for r in docs.select("doc_id", language_id.predict(model, docs, F.col("text")).alias("p")).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[3].score == 0
    assert got[1].lang_pred == "en"
    none = docs.limit(0)
    empty = language_id.fit(none)
    assert {r.p.lang_pred for r in docs.select(language_id.predict(empty, docs, F.col("text")).alias("p")).collect()} == {"und"}


def test_quality_of_held_out_documents(spark, larger):
    label, found = held_out(spark, larger, queries.op7_quality_ranking, "quality")
    assert area(label, [r.score for r in found]) > 0.97
    assert all(r.predicted == (r.score >= 0.7) for r in found)


def test_pairs_learn_a_known_order():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, quality_ranking.N_FEATURES))
    truth = draw.normal(size=quality_ranking.N_FEATURES)
    label = (x @ truth > -0.5).astype(int)
    model = quality_ranking.fit_pairs(x, label, 0.7)
    score = quality_ranking.score_matrix(x, model, 0.7)
    assert area(label, score) > 0.999 and abs((score < 0.7).mean() - (label == 0).mean()) < 0.01


def test_every_pair_counts():
    """Against a loop over all pairs: none is drawn."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(150, quality_ranking.N_FEATURES))
    label = (x[:, 0] + 2 * draw.normal(size=len(x)) > 0.3).astype(int)
    model = quality_ranking.fit_pairs(x, label, 0.7)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    diff = (z[label == 1][:, None, :] - z[label == 0][None, :, :]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(diff @ w))
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + 1e-3 * np.eye(len(w))
        w = w + np.linalg.solve(curve, diff.T @ p / len(diff) - 1e-3 * w)
    assert np.abs(model.weights - w).max() < 0.002 * np.abs(w).max()


def test_quality_learns_from_every_labelled_row(spark):
    """More rows than any sample held, the tasks' sums the same as those of all rows in one place."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(25_000, quality_ranking.N_FEATURES)).round(3)
    label = (x[:, 3] + draw.normal(size=len(x)) > 0).astype(int)
    rows = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "x": x.tolist()}), "id long, x array<double>").repartition(5)
    labels = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(x)), "quality": label}), "doc_id long, quality int")
    got, one = quality_ranking.fit_measured(rows, labels, 1, 1), quality_ranking.fit_pairs(x, label, 0.7)
    assert np.allclose(got.mean, one.mean) and np.allclose(got.scale, one.scale) and np.allclose(got.weights, one.weights, rtol=1e-5, atol=1e-7)
    assert abs(got.slope - one.slope) < 1e-5 and abs(got.cut - one.cut) < 1e-6


def test_toxicity_of_held_out_documents(spark, larger):
    label, found = held_out(spark, larger, queries.op9_toxicity, "toxic")
    assert area(label, [r.score for r in found]) > 0.8
    clean = [r.predicted for r, t in zip(found, label, strict=True) if t == 0]
    assert np.mean(clean) < 0.05


def test_lexicon_as_by_edit_distance():
    draw = random.Random(1)
    terms = {"".join(draw.choice("ab") for _ in range(draw.randint(3, 7))): draw.random() for _ in range(30)}
    lexicon = toxicity.Lexicon(terms)

    def close(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
            row = new
        return row[-1] <= 1

    for _ in range(3000):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(0, 8)))
        near = [t for t in terms if len(t) >= 5 and close(word, t)]
        expected = (word, 0) if word in terms else (min(near, key=lambda t: (-terms[t], t)), 1) if near else None
        assert lexicon.find(word) == expected


def test_quotation_is_not_abuse():
    scanner = toxicity.Scanner({"idiot": 5.0, "moron": 5.0}, 12)
    abuse, quoted, misspelled = (scanner.features(t.encode()) for t in ("you idiot, you moron", 'they said "idiot" and "you moron"', "you idjot"))
    assert abuse[1] == 10 and abuse[3] == 0
    assert quoted[1] == 0 and quoted[3] > 0
    assert misspelled[1] == 0 and misspelled[2] > 0


def test_models_on_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, None, None), (None, 0, 1), (7, 0, 1), (99, 1, 1)], LABELS)
    for known in (labels, labels.limit(0)):
        quality, toxic = quality_ranking.fit(docs, known, 4, 2), toxicity.fit(docs, known, 5, 0)
        got = docs.select("doc_id", quality_ranking.predict(quality, as_bytes("text")).alias("q"), toxicity.predict(toxic, as_bytes("text")).alias("t")).collect()
        assert len(got) == docs.count() and all(0 <= r.q <= 1 and 0 <= r.t <= 1 for r in got)
        assert len({(r.q, r.t) for r in got if r.doc_id in (3, 4, 5)}) == 1


def test_a_null_id_is_not_held_out(spark):
    docs = spark.createDataFrame([(None,), (1,)], "doc_id long")
    assert {r.doc_id: r.h for r in docs.select("doc_id", in_bucket("doc_id", 3, 1).alias("h")).collect()}[None] is False


def test_terms_do_not_depend_on_how_many_words_a_task_holds(spark):
    """A word of the same texts that is handed on twice counts once."""
    rows = [(k, int(k % 2), f"{'vile ugly' if k % 2 else 'fine day'} number {k % 7} of {k}") for k in range(60)]
    frame = spark.createDataFrame(rows, "id long, label int, text string")
    few, all_at_once = (toxicity.learn_terms(frame, held=n) for n in (1, 1_000_000))
    assert few == all_at_once and {"vile", "ugly"} <= set(few)
