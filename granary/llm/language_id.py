"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from granary.llm.common import small_batches

UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    """``log_prob`` has a row for each language and ``orders * 2**bits`` columns."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    orders: tuple[int, ...]
    bits: int


def gram_buckets(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram that starts at each code point, in a range of its own."""
    for place, n in enumerate(orders):
        size = max(0, len(codes) - n + 1)
        mixed = np.zeros(size, np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k:k + size]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        yield (mixed >> np.uint32(32 - bits)).astype(np.int64) + (place << bits)


def blocks(texts: list[str], size: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of many texts in blocks of about ``size``, with the text each code point belongs to.

    Texts are lower-cased. A text longer than a block goes on in the next one,
    which repeats its last ``overlap`` code points, so that no n-gram is lost.
    A zero stands between two texts.
    """
    codes, owners, held = [], [], 0
    for number, text in enumerate(texts):
        code = np.frombuffer((text.lower() + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        for start in range(0, len(code), size):
            part = code[max(0, start - overlap):start + size]
            if start:  # what came before is in the block just given out
                yield np.concatenate(codes), np.concatenate(owners)
                codes, owners, held = [], [], 0
            codes.append(part)
            owners.append(np.full(len(part), number, np.int32))
            held += len(part)
        if held >= size:
            yield np.concatenate(codes), np.concatenate(owners)
            codes, owners, held = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(owners)


def _grams(codes: np.ndarray, orders: tuple[int, ...], bits: int, again: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the n-grams within one text, and where they start.

    The first ``again`` code points were in the block before; n-grams wholly in them are left out.
    """
    ends = np.flatnonzero(codes == 0)
    for n, found in zip(orders, gram_buckets(codes, orders, bits), strict=True):
        inside = np.ones(len(found), bool)
        for k in range(n):  # n-grams that hold a text's end
            at = ends - k
            inside[at[(at >= 0) & (at < len(found))]] = False
        inside[:max(0, again - n + 1)] = False
        at = np.flatnonzero(inside)
        yield found[at], at


def _walk(texts: list[str], orders: tuple[int, ...], bits: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of every n-gram, a block and an order at a time."""
    overlap, before = max(orders) - 1, -1
    for codes, owners in blocks(texts, size, overlap):
        again = overlap if owners[0] == before else 0
        for found, at in _grams(codes, orders, bits, again):
            yield found, owners[at]
        before = owners[-1] if codes[-1] != 0 else -1


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", orders: tuple[int, ...] = (1, 2, 3),
        bits: int = 14, alpha: float = 0.1, max_languages: int = 256) -> Model:
    """Count n-grams per language over all ``docs`` with a language and a text.

    Each task adds up its counts before the shuffle. The model has at most
    ``max_languages`` rows; more distinct languages raise ValueError, since a
    column with so many values is no language column. Rows with a null language
    or text are left out; without any row the model has no language.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    prior = rows.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if len(prior) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    width = len(orders) << bits

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                into = total.setdefault(lang, np.zeros(width, np.int64))
                for found, _ in _walk(texts.tolist(), orders, bits, 1 << 20):
                    into += np.bincount(found, minlength=width)
        for lang, into in total.items():
            at = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": into[at]})

    found = (rows.mapInPandas(counts, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    languages = [r["lang"] for r in prior]
    table = np.full((len(languages), width), alpha)
    if len(found):
        place = found["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy()
        table[place, found["gram"].to_numpy()] += found["n"].to_numpy()
    for k in range(len(orders)):
        part = table[:, k << bits:(k + 1) << bits]
        part /= part.sum(axis=1, keepdims=True)
    docs_of = np.array([r["count"] for r in prior], float)
    return Model(languages, np.log(docs_of / max(1.0, docs_of.sum())), np.log(table).astype(np.float32), orders, bits)


def score_texts(texts: list[str | None], model: Model, size: int = 1 << 18) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior probability for each text; ties go to the first by name."""
    total = np.tile(model.log_prior, (len(texts), 1)) if model.languages else np.zeros((len(texts), 1))
    known = [t is not None and any(map(str.isalpha, t)) for t in texts]
    if model.languages:
        for found, owners in _walk([t if k else "" for t, k in zip(texts, known, strict=True)], model.orders, model.bits, size):
            if not len(found):
                continue
            starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            for lang in range(len(model.languages)):
                total[owners[starts], lang] += np.add.reduceat(model.log_prob[lang][found].astype(np.float64), starts)
    best = total.argmax(axis=1)
    share = np.exp(total - total.max(axis=1, keepdims=True))
    posterior = 1.0 / share.sum(axis=1)
    sure = np.array([k and bool(model.languages) for k in known], bool)
    return [model.languages[b] if k else UNDETERMINED for b, k in zip(best, sure, strict=True)], np.where(sure, posterior, 0.0)


def predict(model: Model, docs: DataFrame, text: Column) -> Column:
    """A struct (lang_pred, score) of each text; the model is broadcast once.

    A null text, or one without a letter, is ``und`` with score 0. Whole texts
    are scored, in blocks of bounded size.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_prob, model.orders, model.bits))

    @pandas_udf("lang_pred string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = Model(*shared.value)
        for batch in batches:
            names, posterior = score_texts([t if isinstance(t, str) else None for t in batch], learned)
            yield pd.DataFrame({"lang_pred": names, "score": posterior})

    return score(text)
