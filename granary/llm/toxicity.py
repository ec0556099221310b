"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, and scores of windows in context."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from granary.llm.common import as_bytes, labelled_sample

_EDGE = b".,;:!?\"'()[]{}<>*_~`|/\\-#%&$+=@^"
_QUOTES = (b'"', "“".encode(), "”".encode(), "„".encode(), "«".encode(), "»".encode())
N_FEATURES = 7


def normal(word: bytes) -> bytes:
    """Lower-cased word without punctuation at its ends."""
    return word.strip(_EDGE)


class Lexicon:
    """Terms with weights in a trie of code points.

    ``find`` intersects the trie with the Levenshtein automaton of a word, for
    one edit at most. A state of the automaton is (letters of the word used up,
    edits made); a trie node is only entered with the states that are alive there.
    """

    def __init__(self, terms: dict[str, float], least_fuzzy: int = 5):
        self.terms, self.least = terms, least_fuzzy
        self.trie: dict = {}
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for term in terms:
            node = self.trie
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            if (n := len(term)) >= least_fuzzy:
                self.heads.setdefault(n, set()).add(term[:n // 2])
                self.tails.setdefault(n, set()).add(term[n // 2:])

    def find(self, word: str) -> tuple[str, int] | None:
        """Nearest term and its distance, 0 or 1; the heavier, then the first by name, where several are as near."""
        if word in self.terms:
            return word, 0
        for n in range(max(self.least, len(word) - 1), len(word) + 2):
            # A term within one edit of a word has its first or its second half unchanged at the word's end.
            if n in self.heads and (word[:n // 2] in self.heads[n] or word[-(n - n // 2):] in self.tails[n]):
                found = {t for t in self._one_edit(word) if len(t) >= self.least}
                return (min(found, key=lambda t: (-self.terms[t], t)), 1) if found else None
        return None

    def _rest(self, node: dict, word: str, at: int) -> Iterator[str]:
        """The term that the rest of the word spells from a node on."""
        for letter in word[at:]:
            node = node.get(letter)
            if node is None:
                return
        if "" in node:
            yield node[""]

    def _one_edit(self, word: str) -> Iterator[str]:
        node = self.trie
        for at in range(len(word) + 1):
            if at < len(word):
                yield from self._rest(node, word, at + 1)  # a letter too many
            for letter, below in node.items():
                if letter:
                    yield from self._rest(below, word, at)  # a letter left out
                    if at < len(word) and letter != word[at]:
                        yield from self._rest(below, word, at + 1)  # another letter
            if at == len(word) or (node := node.get(word[at])) is None:
                return


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    weights: np.ndarray
    window: int


class Scanner:
    """Features of texts; remembers what each distinct word matches, for a bounded number of words."""

    def __init__(self, terms: dict[str, float], window: int, limit: int = 200_000):
        self.lexicon, self.window, self.limit = Lexicon(terms), window, limit
        self.clean: set[bytes] = set()
        self.old: set[bytes] = set()
        self.hits: dict[bytes, tuple[float, int]] = {}

    def features(self, text: bytes | None) -> np.ndarray:
        """Evidence of a text: one, heaviest window, fuzzy weight, quoted weight, distinct terms, hits, share.

        A window adds up the weights of exact terms within ``window`` words of
        each other; a misspelled term counts on its own account, and so does one
        that stands between quotation marks.
        """
        out = np.zeros(N_FEATURES)
        out[0] = 1.0
        words = text.lower().split() if text else []
        kinds = set(words)
        for word in kinds - self.clean:
            if word in self.hits:
                continue
            if word in self.old:
                self.clean.add(word)
                continue
            found = self.lexicon.find(normal(word).decode("utf-8", "replace"))
            if found:
                if len(self.hits) >= self.limit:
                    self.hits.clear()
                self.hits[word] = (self.lexicon.terms[found[0]], found[1])
            else:
                self.clean.add(word)
        known = [w for w in kinds if w in self.hits]
        if known:
            self._weigh(words, set(known), any(q in text for q in _QUOTES), out)
        if len(self.clean) >= self.limit:  # words without a match of late are remembered
            self.clean, self.old = set(), self.clean
        return out

    def _weigh(self, words: list[bytes], known: set[bytes], has_quotes: bool, out: np.ndarray) -> None:
        quoted, exact, at = False, [], []
        looked_at = enumerate(words) if has_quotes else [(k, w) for k, w in enumerate(words) if w in known]
        for place, word in looked_at:
            marks = sum(word.count(q) for q in _QUOTES) if has_quotes else 0
            if word in known:
                weight, edits = self.hits[word]
                if quoted or marks >= 2:
                    out[3] += weight
                elif edits:
                    out[2] += weight
                else:
                    exact.append(weight)
                    at.append(place)
            quoted ^= bool(marks % 2)
        if exact:
            total, places = np.r_[0.0, np.cumsum(exact)], np.array(at)
            first = np.searchsorted(places, places - self.window)
            out[1] = float((total[1:] - total[first]).max())
        out[2], out[3] = math.log1p(out[2]), math.log1p(out[3])
        out[4] = math.log1p(len({normal(w) for w in known}))
        out[5] = math.log1p(len(exact))
        out[6] = min(1.0, len(exact) / len(words))


def learn_terms(rows: DataFrame, least_docs: int = 3, least_odds: float = 2.5, most: int = 4096, held: int = 100_000) -> dict[str, float]:
    """Words that documents with label 1 hold far more often than others, weighted by log odds.

    A document counts by the smallest hash of its 3-word shingles, so that a
    group of copies is one piece of evidence. At most ``most`` terms, those in
    most such documents, make the lexicon.
    """
    def vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: set[tuple[bytes, int, int]] = set()
            for label, text in zip(batch["label"], batch["text"], strict=True):
                words = text.lower().split() if text else []
                if words:
                    shape = min(_hash(b" ".join(words[k:k + 3])) for k in range(max(1, len(words) - 2)))
                    found.update((normal(w), shape, label) for w in set(words))
                if len(found) > held:
                    yield rows_of(found)
                    found.clear()
            yield rows_of(found)

    def rows_of(found: set[tuple[bytes, int, int]]) -> pd.DataFrame:
        out = pd.DataFrame(list(found), columns=["term", "shape", "label"])
        return out.assign(term=out["term"].map(lambda t: t.decode("utf-8", "replace")))

    seen = (rows.select("label", as_bytes("text").alias("text")).mapInPandas(vocabulary, "term string, shape long, label int")
            .groupBy("label", "term").agg(F.countDistinct("shape").alias("n")))
    shapes = rows.select("label", "id").groupBy("label").count()
    total = {r["label"]: r["count"] for r in shapes.collect()}
    by = (seen.groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                   F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("good"))
          .where(F.col("bad") >= least_docs))
    odds = F.log((F.col("bad") + 0.5) / (total.get(1, 0) + 1.0)) - F.log((F.col("good") + 0.5) / (total.get(0, 0) + 1.0))
    chosen = by.withColumn("odds", odds).where((F.col("odds") >= least_odds) & (F.length("term") >= 3))
    chosen = chosen.orderBy(F.desc("bad"), F.desc("odds"), "term").limit(most)
    return {r["term"]: float(r["odds"]) for r in chosen.select("term", "odds").collect()}


def _hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data) >> 1


def fit_logistic(x: np.ndarray, label: np.ndarray, l2: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; zeros but a low constant where no row has label 1."""
    w = np.zeros(N_FEATURES)
    if not (label == 1).any():
        w[0] = -4.0
        return w
    ridge = np.diag(np.r_[1e-6, np.full(N_FEATURES - 1, l2)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x / len(x) + ridge
        step = np.linalg.solve(curve, x.T @ (label - p) / len(x) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, label: str = "toxic",
        window: int = 12, sample: int = 20_000) -> Model:
    """Lexicon and weights from at most ``sample`` labelled documents outside the held-out remainder.

    Counts run on Spark; the driver gets at most 4096 terms and one short row of
    features a sampled document. Weights are fitted on the half of the sample
    that the lexicon hasn't seen, then on the lexicon of all of it.
    """
    rows = labelled_sample(docs, labels, label, modulus, remainder, sample)
    half = F.xxhash64("id", F.lit("half")) % 2 == 0
    terms = learn_terms(rows.where(half))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(terms, window)
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [scanner.features(t) for t in batch["text"]]})

    got = (rows.where(~half).select("label", as_bytes("text").alias("text"))
           .mapInPandas(measured, "label int, x array<double>").orderBy("label", "x").toPandas())
    x = np.array(got["x"].tolist(), float).reshape(-1, N_FEATURES)
    return Model(learn_terms(rows), fit_logistic(x, got["label"].to_numpy()), window)


def predict(model: Model, text: Column) -> Column:
    """Score of each whole text, given as bytes. Null and empty texts have the score of a text without any term."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(model.terms, model.window)
        for batch in batches:
            x = np.array([scanner.features(t if isinstance(t, bytes) else None) for t in batch]).reshape(-1, N_FEATURES)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))

    return score(text)
