"""Quality classifier: Bradley-Terry scores learned from preference pairs of documents."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from granary.llm.common import as_bytes, in_bucket, small_batches
from granary.session import stage

_SYMBOLS = b"#*$%&|<>"
_STOPS = b".!?"
N_FEATURES = 17


def features(text: bytes | None) -> np.ndarray:
    """Shape of a text: lengths, symbols, repetition, lines and kinds of characters; zeros where there is no word."""
    out = np.zeros(N_FEATURES)
    words = text.split() if text else []
    if not words:
        return out
    n, kinds = len(words), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    distinct = set(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    size = len(text)
    tops = pd.Series(words).value_counts().iloc[0] if len(distinct) < n else 1
    marks = sum(int(kinds[b]) for b in _SYMBOLS)
    alphabetic = int(kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum())
    out[:] = (
        math.log1p(n),
        min(1.0, marks / n),
        sum(1 for w in words if len(w) == 1 and w in _SYMBOLS) / n,
        1 - len(set(lines)) / len(lines),
        (n - len(distinct)) / n,
        len(distinct) / n ** 0.75 if n > 1 else 1.0,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        lengths.mean(),
        lengths.std(),
        math.log1p(int(lengths.max())),
        int(kinds[48:58].sum()) / size,
        int(kinds[65:91].sum()) / size,
        alphabetic / size,
        min(1.0, sum(int(kinds[b]) for b in _STOPS) / n),
        min(1.0, len(lines) / n),
        tops / n,
        float((lengths <= 3).mean()),
    )
    return out


@dataclass(frozen=True)
class Model:
    """Utility is ``weights @ (x - mean) / scale``; ``cut`` is its value at the chosen quantile."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    cut: float


#: Bins of utility on either side of zero; rows of a bin count as lying at its mean.
_BINS = 256
_WIDTH = 2 + N_FEATURES + N_FEATURES ** 2


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def bin_sums(batches: Iterator[tuple[np.ndarray, np.ndarray]], mean: np.ndarray, scale: np.ndarray, w: np.ndarray, width: float) -> np.ndarray:
    """For each label and bin of utility: rows, sum of utilities, of scaled features, and of their products."""
    out = np.zeros((2, 2 * _BINS, _WIDTH))
    for x, label in batches:
        z = _scaled(x, mean, scale)
        u = z @ w
        at = np.clip(np.floor(u / width) + _BINS, 0, 2 * _BINS - 1).astype(int)
        products = (z[:, :, None] * z[:, None, :]).reshape(len(z), -1)
        np.add.at(out, (label, at), np.hstack([np.ones((len(z), 1)), u[:, None], z, products]))
    return out


def newton_step(sums: np.ndarray, w: np.ndarray, l2: float) -> np.ndarray:
    """Newton step over all pairs of a row of label 1 with one of label 0, from :func:`bin_sums`.

    The loss of a pair hangs on the two utilities alone, so pairs of two bins
    are added up together: the work is that of the bins, whatever the rows.
    """
    (nb, ub, xb, sb), (ng, ug, xg, sg) = [
        (s[:, 0], s[:, 1] / s[:, 0], s[:, 2:2 + N_FEATURES], s[:, 2 + N_FEATURES:]) for s in (side[side[:, 0] > 0] for side in sums)
    ]
    pairs = ng.sum() * nb.sum()
    p = 1 / (1 + np.exp(np.clip(ug[:, None] - ub[None, :], -30, 30)))
    h = p * (1 - p)
    slope = ((p @ nb) @ xg - (ng @ p) @ xb) / pairs
    across = xg.T @ h @ xb
    curve = (((h @ nb) @ sg + (ng @ h) @ sb).reshape(N_FEATURES, N_FEATURES) - across - across.T) / pairs
    return np.clip(np.linalg.solve(curve + l2 * np.eye(N_FEATURES), slope - l2 * w), -5, 5)


def learn(summed: Callable[[np.ndarray, float], np.ndarray], l2: float = 1e-3, rounds: int = 25, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights by Newton steps, and the spread of utilities; ``summed`` gives :func:`bin_sums` of all rows for weights and a width."""
    w, spread = np.zeros(N_FEATURES), 0.0
    every = None
    for _ in range(rounds):
        # Bins of a width of their own for each power of two, so that they stay where they are in the last rounds.
        width = 2.0 ** math.ceil(math.log2(max(spread, 1e-3) / 64))
        sums = summed(w, width)
        if every is None:
            total = sums.sum(axis=(0, 1))
            middle = total[2:2 + N_FEATURES] / total[0]
            every = total[2 + N_FEATURES:].reshape(N_FEATURES, N_FEATURES) / total[0] - np.outer(middle, middle)
        step = newton_step(sums, w, l2)
        w = w + step
        spread = math.sqrt(max(0.0, float(w @ every @ w)))
        if np.abs(step).max() < tolerance:
            break
    return w, spread


def _without_labels(mean: np.ndarray, scale: np.ndarray) -> Model:
    return Model(mean, scale, np.zeros(N_FEATURES), 1.0, 0.0)


def fit_pairs(x: np.ndarray, label: np.ndarray, threshold: float) -> Model:
    """Learn weights so that in a pair the preferred document has the larger utility; rows in one place.

    A pair holds one document with label 1 and one with label 0, and all such
    pairs count; the loss is ``log(1 + exp(-w.(a - b)))`` with an L2 term,
    minimised by Newton steps. The cut is the utility's quantile at the share of
    label 0. Without both labels all weights are 0 and every document is kept.
    """
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not (label == 1).any() or not (label == 0).any():
        return _without_labels(mean, scale)
    w, spread = learn(lambda w, width: bin_sums([(x, label)], mean, scale, w, width))
    cut = float(np.quantile(_scaled(x, mean, scale) @ w, (label == 0).mean()))
    return Model(mean, scale, w, 1.0 / max(1e-6, spread), cut)


def score_matrix(x: np.ndarray, model: Model, threshold: float) -> np.ndarray:
    """Scores from 0 to 1, of which the one at the model's cut is ``threshold``."""
    utility = _scaled(x, model.mean, model.scale) @ model.weights
    return 1 / (1 + np.exp(-np.clip(4 * model.slope * (utility - model.cut) + math.log(threshold / (1 - threshold)), -30, 30)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``features`` of each whole text, written once: what models learn from and what they score."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "x": [features(t if isinstance(t, bytes) else None) for t in batch["text"]]})

    id_type = rows.schema["id"].dataType.simpleString()
    return stage(rows.mapInPandas(measure, f"id {id_type}, x array<double>"), "features")


def fit(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, label: str = "quality", threshold: float = 0.7) -> Model:
    """Fit on all labelled documents outside the held-out remainder."""
    return fit_measured(measured(docs), labels, modulus, remainder, label, threshold)


def fit_measured(rows: DataFrame, labels: DataFrame, modulus: int, remainder: int, label: str = "quality", threshold: float = 0.7,
                 id_col: str = "doc_id") -> Model:
    """Fit on all labelled ones of ``measured`` rows outside the held-out remainder, over all their pairs as :func:`fit_pairs` does.

    Of several labels of one id the largest counts, labels above 1 as 1 and others
    as 0. A round adds up its sums where the rows are; of these, at most
    two rows a bin come to the driver. The cut is off by 1 / 100,000 of the rows at most.
    """
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~in_bucket("id", modulus, remainder))
              .groupBy("id").agg(F.max("label").alias("label")))
    known = stage(rows.join(chosen, "id").select((F.col("label") >= 1).cast("int").alias("label"), "x"), "labelled")
    each = range(N_FEATURES)
    whole = known.agg(F.count("*"), F.count_if(F.col("label") == 0), *[F.avg(F.get("x", F.lit(i))) for i in each],
                      *[F.stddev_pop(F.get("x", F.lit(i))) for i in each]).first()
    n, bad, numbers = whole[0], whole[1], np.array(whole[2:], float)
    mean, scale = (numbers[:N_FEATURES], numbers[N_FEATURES:]) if n else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not 0 < bad < n:
        return _without_labels(mean, scale)

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            if len(batch):
                yield np.array(batch["x"].tolist(), float), batch["label"].to_numpy()

    def summed(w: np.ndarray, width: float) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = bin_sums(arrays(batches), mean, scale, w, width)
            label, at = np.nonzero(sums[:, :, 0])
            yield pd.DataFrame({"label": label, "bin": at, "sums": [*sums[label, at]]})

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # In order of size, so that the order in which tasks end makes no difference.
            some = pd.concat([pd.DataFrame(columns=["label", "bin", "sums"]), *batches])
            totals = [(*at, np.sort(np.stack(one["sums"].to_list()), axis=0).sum(axis=0)) for at, one in some.groupby(["label", "bin"])]
            yield pd.DataFrame(totals, columns=["label", "bin", "sums"])

        kind = "label int, bin int, sums array<double>"
        out = np.zeros((2, 2 * _BINS, _WIDTH))
        # However many partitions the shuffle has, few Python workers add them up.
        for r in known.mapInPandas(part, kind).repartition("bin").coalesce(16).mapInPandas(added, kind).collect():
            out[r.label, r.bin] = r.sums
        return out

    w, spread = learn(summed)

    def utilities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x, _ in arrays(batches):
            yield pd.DataFrame({"u": _scaled(x, mean, scale) @ w})

    # The quantile lies between the rows of these two ranks, as numpy has it.
    ranks = [(bad - 0.5) / n, (bad + 0.5) / n]
    below, above = known.mapInPandas(utilities, "u double").agg(F.percentile_approx("u", ranks, 100_000)).first()[0]
    return Model(mean, scale, w, 1.0 / max(1e-6, spread), below + (1 - bad / n) * (above - below))


def score(model: Model, x: Column, threshold: float = 0.7) -> Column:
    """Score of each text from its features, as ``measured`` gives them."""

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(score_matrix(np.array(batch.tolist(), float).reshape(-1, N_FEATURES), model, threshold))

    return scored(x)


def predict(model: Model, text: Column, threshold: float = 0.7) -> Column:
    """Score of each whole text, given as bytes. Null and empty texts have all features zero and are scored as such."""

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t if isinstance(t, bytes) else None) for t in batch]).reshape(-1, N_FEATURES)
            yield pd.Series(score_matrix(x, model, threshold))

    return scored(text)
