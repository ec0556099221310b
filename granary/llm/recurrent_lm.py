"""Gated recurrent language model with a class-factored softmax, trained and applied in numpy."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import as_bytes, in_bucket, small_batches
from granary.session import stage

NONE = -1e4  # bias of what can't occur


@dataclass(frozen=True)
class Shape:
    """Sizes of the model.

    The ``words`` most frequent tokens have an output of their own, in classes of
    ``in_class``. All others are in ``tails`` classes by their last two bytes,
    within which they are as likely as their counts say.
    """

    hidden: int = 16
    words: int = 1024
    in_class: int = 32
    tails: int = 48

    @property
    def heads(self) -> int:
        return self.words // self.in_class

    @property
    def classes(self) -> int:
        return self.heads + self.tails

    def tail(self, word: bytes) -> int:
        return zlib.crc32(word[-2:]) % self.tails


class Tails(dict):
    """Code of the tail class by a word's last two bytes, worked out once for each."""

    def __init__(self, shape: Shape):
        super().__init__()
        self.shape = shape

    def __missing__(self, last: bytes) -> int:
        found = self[last] = self.shape.words + self.shape.tail(last)
        return found


def tokens(text: bytes | None) -> list[bytes]:
    """Words split at ASCII white space, A-Z in lower case."""
    return text.lower().split() if text else []


def initial(shape: Shape, class_counts: np.ndarray, word_counts: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights of a model that gives unigram probabilities until it has learned more."""
    draw, h = np.random.default_rng(seed), shape.hidden
    word = np.where(word_counts > 0, np.log(np.maximum(word_counts, 1)), NONE).reshape(shape.heads, shape.in_class)
    group = np.where(class_counts > 0, np.log(np.maximum(class_counts, 1)), NONE)
    out = {
        "x": draw.normal(0, 0.1, (shape.words + shape.tails + 1, 3 * h)),  # by input token; the last begins a text
        "u": draw.normal(0, 1 / np.sqrt(h), (h, 3 * h)),
        "c": draw.normal(0, 0.05, (h, shape.classes)),
        "cb": group - group.max(),
        "w": draw.normal(0, 0.05, (shape.heads, h, shape.in_class)),
        "wb": word - word.max(axis=1, keepdims=True),
    }
    return {k: v.astype(np.float32) for k, v in out.items()}


def _thirds(p: dict[str, np.ndarray], k: str) -> list[np.ndarray]:
    """Weights of update gate, reset gate and candidate by themselves; those of the gates are halved.

    A gate, 1 / (1 + exp(-a)), is then (1 + tanh(a / 2)) / 2.
    """
    size = p["u"].shape[0]
    z, r, n = (p[k][:, j * size:(j + 1) * size] for j in range(3))
    return [z * np.float32(0.5), r * np.float32(0.5), n.copy()]


def _gate(a: np.ndarray) -> np.ndarray:
    """A gate from half of its argument, in place."""
    np.tanh(a, out=a)
    a += 1
    a *= 0.5
    return a


def _step(h: np.ndarray, x: list[np.ndarray], u: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Next state of each lane, and update gate, reset gate, candidate and its recurrent part; ``x`` and ``u`` in thirds."""
    z, r, part = h @ u[0], h @ u[1], h @ u[2]
    z += x[0]
    r += x[1]
    _gate(z), _gate(r)
    n = r * part
    n += x[2]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, z, r, n, part


def _spread(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether exp of ``h @ weights + bias`` can be summed as it is, for any state: none is too large, and the largest not too small."""
    reach = np.abs(weights).sum(axis=-2)
    return bool((bias + reach).max() < 60 and (bias - reach).max(axis=-1).min() > -60)


def output(shape: Shape, p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each target code given its state; with ``grads``, also the loss's gradient by state.

    A target below ``words`` is a word: its class, then the word within it. One
    from there on is a tail class only.
    """
    word = target < shape.words
    group = np.where(word, target // shape.in_class, target - shape.words + shape.heads)
    out, dh = np.empty(len(h), h.dtype), None if grads is None else np.empty_like(h)
    spread, ones = _spread(p["c"], p["cb"]), np.ones(shape.classes, h.dtype)
    for start in range(0, len(h), 2048):  # as many rows as stay in a processor's cache
        some = slice(start, start + 2048)
        logits = h[some] @ p["c"]
        logits += p["cb"]
        if not spread:
            logits -= logits.max(axis=1, keepdims=True)
        row, own = np.arange(len(logits)), group[some]
        out[some] = logits[row, own]
        share = np.exp(logits, out=logits)
        total = share @ ones
        out[some] -= np.log(total)
        if grads is not None:
            share /= total[:, None]
            share[row, own] -= 1
            grads["c"] += h[some].T @ share
            grads["cb"] += share.sum(axis=0)
            dh[some] = share @ p["c"].T
    at = np.flatnonzero(word)
    at = at[np.argsort(group[at], kind="stable")]
    edges = np.flatnonzero(np.r_[True, np.diff(group[at]) != 0, True]) if len(at) else np.zeros(1, int)
    spread, ones = _spread(p["w"], p["wb"]), np.ones(shape.in_class, h.dtype)
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        rows, g = at[start:end], group[at[start]]
        inner = h[rows] @ p["w"][g]
        inner += p["wb"][g]
        if not spread:
            inner -= inner.max(axis=1, keepdims=True)
        place, k = target[rows] % shape.in_class, np.arange(len(rows))
        wanted = inner[k, place]
        part = np.exp(inner, out=inner)
        sums = part @ ones
        out[rows] += wanted - np.log(sums)
        if grads is not None:
            part /= sums[:, None]
            part[k, place] -= 1
            grads["w"][g] += h[rows].T @ part
            grads["wb"][g] += part.sum(axis=0)
            dh[rows] += part @ p["w"][g].T
    return out, dh


def flow(docs: Iterable[np.ndarray], width: int, window: int, begin: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Whole documents laid into at most ``width`` lanes, ``window`` steps at a time.

    Gives input and target codes by step and lane (-1 where there is none), and
    which of the lanes of the time before go on. A lane takes the next document
    where its last one ends, so that a long one holds up no other; only one
    document a lane is held.
    """
    source = ((np.r_[begin, d[:-1]], d) for d in docs if len(d))
    held: list = [(None, None, 0)] * width
    still = np.arange(width)
    while True:
        given, wanted = (np.full((len(held), window), -1, np.int32) for _ in range(2))
        for lane, (inputs, targets, at) in enumerate(held):
            t = 0
            while t < window:
                if targets is None:
                    inputs, targets = next(source, (None, None))
                    at = 0
                    if targets is None:
                        break
                n = min(window - t, len(targets) - at)
                given[lane, t:t + n], wanted[lane, t:t + n] = inputs[at:at + n], targets[at:at + n]
                t, at = t + n, at + n
                if at == len(targets):
                    inputs = targets = None
            held[lane] = (inputs, targets, at)
        used = np.flatnonzero(given[:, 0] >= 0)
        if not len(used):
            return
        yield given[used].T, wanted[used].T, still[used]
        held, still = [held[k] for k in used], np.arange(len(used))


def lanes(docs: list[np.ndarray], width: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid one after the other into ``width`` lanes of about the same length, the longest lane first.

    Gives by step and lane: input code, target code (-1 past a lane's end),
    document, and by lane its length. A document's first input is ``begin``.
    """
    order = sorted(range(len(docs)), key=lambda k: (-len(docs[k]), k))
    load, held = np.zeros(width, np.int64), [[] for _ in range(width)]
    for k in order:
        lane = int(load.argmin())
        held[lane].append(k)
        load[lane] += len(docs[k])
    rank = np.argsort(-load, kind="stable")
    load = load[rank]
    steps = int(load.max()) if len(docs) else 0
    given, wanted, owner = (np.full((steps, width), -1, np.int32) for _ in range(3))
    for lane, source in enumerate(rank):
        at = 0
        for k in held[source]:
            n = len(docs[k])
            wanted[at:at + n, lane], owner[at:at + n, lane] = docs[k], k
            given[at, lane], given[at + 1:at + n, lane] = begin, docs[k][:-1]
            at += n
    return given, wanted, owner, load


def score_flow(shape: Shape, p: dict[str, np.ndarray], docs: Iterable[np.ndarray], width: int = 256, window: int = 64) -> Iterator[tuple[int, float]]:
    """Place and log probability (natural) of each document, given as codes, as soon as it is known.

    The state goes on from window to window. Documents are taken as lanes get
    free, so that a long one holds up no other; one without codes comes with 0.
    """
    begin, left, sums, empty, n_docs = shape.words + shape.tails, {}, {}, [], 0

    def numbered() -> Iterator[np.ndarray]:
        nonlocal n_docs
        for doc in docs:
            if len(doc):
                left[len(places)], sums[len(places)] = len(doc), 0.0
                places.append(n_docs)
            else:
                empty.append(n_docs)
            n_docs += 1
            yield doc

    places: list[int] = []  # of the documents with codes, in the order in which lanes take them
    x, u, taken = _thirds(p, "x"), _thirds(p, "u"), 0
    h, carried = np.zeros((width, shape.hidden), np.float32), np.zeros(width, np.int64)
    for given, wanted, still in flow(numbered(), width, window, begin):
        h, live = h[still], given >= 0
        begins = given == begin
        # Lane by lane, documents begin in the order in which they were taken.
        within = begins.cumsum(axis=0)
        first = taken + np.r_[0, within[-1, :-1].cumsum()]
        owner = np.where(within == 0, carried[still], first + within - 1)
        taken, carried = taken + int(within[-1].sum()), owner[-1]
        codes, goes_on, states = np.where(live, given, begin), ~begins[:, :, None], np.empty((*given.shape, shape.hidden), np.float32)
        for t in range(len(given)):
            h = states[t] = _step(h * goes_on[t], [part[codes[t]] for part in x], u)[0]
        got, _ = output(shape, p, states[live], wanted[live])
        low, owners = int(owner.min()), owner[live]
        cells = np.bincount(owners - low)
        added = np.bincount(owners - low, weights=got)
        for k in np.flatnonzero(cells).tolist():
            left[low + k] -= int(cells[k])
            sums[low + k] += float(added[k])
            if not left[low + k]:
                del left[low + k]
                yield places[low + k], sums.pop(low + k)
    yield from ((k, 0.0) for k in empty)


def score(shape: Shape, p: dict[str, np.ndarray], docs: list[np.ndarray], width: int = 256, window: int = 64) -> np.ndarray:
    """Log probability (natural) of each whole document, given as codes."""
    out = np.zeros(len(docs))
    for k, found in score_flow(shape, p, docs, max(1, min(width, len(docs))), window):
        out[k] = found
    return out


def train(shape: Shape, p: dict[str, np.ndarray], docs: Iterable[np.ndarray], updates: int, rate: float,
          width: int = 64, window: int = 32, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights after Adam steps of truncated backpropagation over windows, by every token of all texts.

    The state is carried from window to window, the gradient is not. Windows with
    few tokens are put together for one step. The texts of a list are gone through
    again, in other orders, until ``updates`` steps are made.
    """
    p = {k: v.copy() for k, v in p.items()}
    first, second, grads = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(3))
    begin, size, done, pending, draw = shape.words + shape.tails, shape.hidden, 0, 0, np.random.default_rng(seed)

    def step() -> None:
        nonlocal done, pending
        done += 1
        scale = 1 / pending
        norm = np.sqrt(sum(float((g * scale).ravel() @ (g * scale).ravel()) for g in grads.values()))
        scale *= min(1.0, 1.0 / max(norm, 1e-9))
        for k, g in grads.items():
            g *= scale
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= (rate * (first[k] / (1 - 0.9 ** done)) / (np.sqrt(second[k] / (1 - 0.99 ** done)) + 1e-6)).astype(np.float32)
            g[...] = 0
        pending = 0

    texts, again = docs, False
    while True:
        if isinstance(docs, list):
            texts = [docs[k] for k in draw.permutation(len(docs))]
        h = np.zeros((width, size), np.float32)
        for given, wanted, still in flow(texts, width, window, begin):
            h = h[still]
            live = given >= 0
            codes = np.where(live, given, begin)
            goes_on, x, u = (codes != begin)[:, :, None], _thirds(p, "x"), _thirds(p, "u")
            befores, zs, rs, ns, parts, states = (np.empty((*live.shape, size), np.float32) for _ in range(6))
            for t in range(len(given)):
                np.multiply(h, goes_on[t], out=befores[t])
                h, zs[t], rs[t], ns[t], parts[t] = _step(befores[t], [w[codes[t]] for w in x], u)
                states[t] = h
            _, part_dh = output(shape, p, states[live], wanted[live], grads)
            by_state, back = np.zeros_like(states), np.zeros_like(h)
            by_state[live] = part_dh
            by_part, dns, back_u = np.empty((*live.shape, 3 * size), np.float32), np.empty_like(states), np.ascontiguousarray(p["u"].T)
            # What the way back multiplies by, for all steps at once.
            to_n, to_z, to_r = (1 - zs) * (1 - ns * ns), (befores - ns) * zs * (1 - zs), parts * rs * (1 - rs)
            for t in range(len(given) - 1, -1, -1):
                dh, dn = by_state[t], dns[t]
                dh += back
                np.multiply(dh, to_n[t], out=dn)
                np.multiply(dh, to_z[t], out=by_part[t, :, :size])
                np.multiply(dn, to_r[t], out=by_part[t, :, size:2 * size])
                np.multiply(dn, rs[t], out=by_part[t, :, 2 * size:])
                back = by_part[t] @ back_u
                back += dh * zs[t]
                back *= goes_on[t]
            grads["u"] += befores.reshape(-1, size).T @ by_part.reshape(-1, 3 * size)
            by_input = by_part
            by_input[:, :, 2 * size:] = dns
            order = np.argsort(codes, axis=None, kind="stable")
            sorted_codes = codes.reshape(-1)[order]
            edges = np.flatnonzero(np.r_[True, np.diff(sorted_codes) != 0])
            grads["x"][sorted_codes[edges]] += np.add.reduceat(by_input.reshape(-1, 3 * size)[order], edges)
            pending += int(live.sum())
            if 2 * pending >= width * window:
                step()
                if again and done >= updates:
                    return p
        if pending:
            step()
        if not isinstance(docs, list) or not docs or done >= updates:
            return p
        again = True


def shards_for(train_tokens: int, least: int, rounds: int, shard_tokens: int) -> tuple[int, int]:
    """Parts of the texts, one for each round, and shards of each, at least ``least``.

    A shard holds at most about ``shard_tokens``, however many tokens there are.
    """
    return rounds, max(least, -(-train_tokens // (rounds * shard_tokens)))


def mean_weights(made: DataFrame, shards: int, fan: int = 64) -> tuple[int, np.ndarray | None]:
    """Tokens of all shards, and the mean of their weights by tokens; ``None`` without tokens.

    ``made`` has (shard, tokens, weights), the weights as bytes of float32. They are
    added up in a tree: each step brings about ``fan`` of them to a task, which
    holds one sum, until one row is left for the driver.
    """
    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return added(batches, lambda r: r.tokens * np.frombuffer(r.weights, np.float32).astype(np.float64))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return added(batches, lambda r: np.frombuffer(r.weights, np.float64))

    def added(batches: Iterator[pd.DataFrame], part: Callable) -> Iterator[pd.DataFrame]:
        tokens, flat = 0, 0.0
        for batch in batches:
            for r in batch.itertuples():
                tokens, flat = tokens + r.tokens, flat + part(r)
        if tokens:
            yield pd.DataFrame({"shard": [TaskContext.get().partitionId()], "tokens": [tokens], "weights": [flat.tobytes()]})

    add = scaled
    while True:
        shards = -(-shards // fan)
        # In order, so that a task that runs again adds up the same.
        near = made.repartition(shards, "shard").sortWithinPartitions("shard") if shards > 1 else made.coalesce(1).sortWithinPartitions("shard")
        made = stage(near.mapInPandas(add, "shard int, tokens long, weights binary"), "weight-sums")
        add = summed
        if shards == 1:
            break
    found = made.first()
    return (found["tokens"], np.frombuffer(found["weights"], np.float64) / found["tokens"]) if found else (0, None)


def train_shard(shape: Shape, p: dict[str, np.ndarray], docs: Iterator[np.ndarray], updates: int, rate: float,
                seed: int, ahead: int = 4_000_000, window: int = 32) -> tuple[dict[str, np.ndarray], int]:
    """Weights learned from all texts of a shard, and the number of its tokens.

    At most about ``ahead`` tokens are held. Lanes are as many as make about
    ``updates`` steps of them, within bounds.
    """
    held, n = [], 0
    for doc in docs:
        held.append(doc)
        n += len(doc)
        if n >= ahead:
            break
    width, rest = int(np.clip(n // (window * max(1, updates)), 32, 256)), 0

    def counted() -> Iterator[np.ndarray]:
        nonlocal rest
        for doc in docs:
            rest += len(doc)
            yield doc

    texts = held if n < ahead else chain(held, counted())
    out = train(shape, p, texts, updates, rate, width, window, seed)
    return out, n + rest


def count_tokens(train_rows: DataFrame, shape: Shape, limit: int = 400_000) -> DataFrame:
    """Count and tail class of each distinct word of all training texts; tasks add up at most ``limit`` words at a time."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(tokens(text))
                if len(total) > limit:
                    yield frame(total)
                    total.clear()
        yield frame(total)

    def frame(total: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": list(total), "c": list(total.values())})

    tail = F.crc32(F.when(F.length("word") > 2, F.substring("word", -2, 2)).otherwise(F.col("word"))) % shape.tails
    return (train_rows.select("text").mapInPandas(counted, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")).select("word", tail.cast("int").alias("tail"), "c"))


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2, shape: Shape = Shape(), listed: int = 131_072,
                    shards: int = 6, rounds: int = 4, updates: int = 150, shard_tokens: int = 4_000_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model score (log10) of every row of ``docs``, learned from the rows that aren't held out.

    Counts are of all training texts, and so is the network: they are dealt by hash
    to shards of about ``shard_tokens``, at least ``shards`` a round. Each of
    ``rounds`` rounds goes through a part of the shards, and the mean of their
    weights by tokens goes into the next. A shard makes at least ``updates`` steps,
    through all its texts once or more. The counts of the ``listed`` most frequent words
    are sent to the tasks; those of the other words of each document are joined
    by word.

    A null text is empty: its only token is the end. A row with a null id isn't
    held out. Repeated rows are scored each.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.monotonically_increasing_id().alias("copy"),
                       in_bucket(id_col, modulus, remainder).alias("held_out"), as_bytes(text_col).alias("text"))
    learned = rows.where(~F.col("held_out"))
    counts = stage(count_tokens(learned, shape), "counts")
    ends = learned.count()
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens = (whole["n"] or 0) + ends
    log_base = np.log10(train_tokens + whole["v"] + (1 if ends else 0) + 1)
    by_tail = {r["tail"]: (r["n"], r["v"]) for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    # The words of the most frequent classes of counts, as far as they are no more than listed; nothing large is sorted.
    step = F.floor(F.log2("c") * 32)
    sizes, least, held = counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect(), None, 0
    for r in sizes:
        held += r["count"]
        if held > listed:
            break
        least = r["s"]
    top = counts.where(step >= least if least is not None else F.lit(False)).toPandas().sort_values(["c", "word"], ascending=[False, True])

    own = shape.words - 1  # code 0 is the end
    tail_c, tail_v = (np.array([by_tail.get(k, (0, 0))[i] for k in range(shape.tails)], np.int64) for i in range(2))
    np.subtract.at(tail_c, top["tail"].to_numpy(np.int64)[:own], top["c"].to_numpy(np.int64)[:own])
    np.subtract.at(tail_v, top["tail"].to_numpy(np.int64)[:own], 1)
    word_counts = np.zeros(shape.words, np.int64)
    word_counts[0], word_counts[1:1 + min(own, len(top))] = max(1, ends), top["c"].to_numpy()[:own]
    class_counts = np.r_[word_counts.reshape(shape.heads, -1).sum(axis=1), tail_c + 1]

    code = np.where(np.arange(len(top)) < own, np.arange(len(top)) + 1, shape.words + top["tail"].to_numpy(np.int64)).astype(np.int32)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast((
        {w: k for k, w in enumerate(top["word"])}, code, np.log10(top["c"].to_numpy(float) + 1),
        np.log10(tail_c + tail_v + 1.0)))

    def coded(text: bytes | None, place: dict, codes: np.ndarray, tails: Tails) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Codes with the end, places in the list (-1: not in it), and the words not in it."""
        words = tokens(text)
        at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
        out = np.zeros(len(words) + 1, np.int32)
        if len(codes):
            out[:-1] = codes[at]
        unlisted = np.flatnonzero(at < 0)
        rare = [words[k] for k in unlisted.tolist()]
        out[unlisted] = np.fromiter(map(tails.__getitem__, [w[-2:] for w in rare]), np.int32, len(rare))
        return out, at, rare

    parts, a_round = shards_for(int(train_tokens), shards, rounds, shard_tokens)
    kind_of_code = "<u2" if shape.words + shape.tails < 1 << 16 else "<u4"

    end_base = float(np.log10(ends + 1))

    def as_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, codes, log_c, log_tail = table.value
        tails = Tails(shape)
        for batch in batches:
            out = []
            for text in batch["text"]:
                code_of, at, rare = coded(text, place, codes, tails)
                in_tail = code_of[code_of >= shape.words] - shape.words
                listed_at, count = at[at >= 0], Counter(rare)
                # What is the same for a word wherever it stands: its count, and for a tail word its class's total.
                inner = float(log_c[listed_at[listed_at >= own]].sum()) - float(log_tail[in_tail].sum())
                out.append((len(code_of), len(listed_at) + (ends > 0), float(log_c[listed_at].sum()) + end_base, inner,
                            list(count), list(count.values()), code_of.astype(kind_of_code).tobytes()))
            made = pd.DataFrame(out, columns=["n_tokens", "n_listed", "base", "inner", "words", "times", "codes"])
            yield made.assign(**{c: batch[c].to_numpy() for c in ("id", "copy", "held_out")})

    counted = "id string, copy long, held_out boolean, n_tokens long, n_listed long, base double, inner double"
    # Read once for training and for scoring.
    texts = stage(rows.mapInPandas(as_codes, f"{counted}, words array<binary>, times array<long>, codes binary"), "codes")
    training = texts.where(~F.col("held_out")).select("copy", "codes", F.pmod(F.xxhash64("copy", F.lit("part")), F.lit(parts)).alias("part"))

    def local_training(now: Broadcast, turn: int) -> Callable:
        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            docs = (np.frombuffer(c, kind_of_code).astype(np.int32) for batch in batches for c in batch["codes"])
            shard = TaskContext.get().partitionId()
            found, n = train_shard(shape, now.value, docs, updates, 0.01 / (1 + turn), 100 * turn + shard)
            if n:
                yield pd.DataFrame({"shard": [shard], "tokens": [n], "weights": [b"".join(found[k].tobytes() for k in sorted(found))]})
        return local

    p = initial(shape, class_counts, word_counts)
    for turn in range(rounds):
        dealt = (training.where(F.col("part") == turn % parts).repartition(a_round, F.xxhash64("copy"))
                 .sortWithinPartitions(F.xxhash64("copy", F.lit("order")), "copy").select("codes"))
        made = stage(dealt.mapInPandas(local_training(spark.sparkContext.broadcast(p), turn), "shard int, tokens long, weights binary"), "weights")
        total, flat = mean_weights(made, a_round)
        if total:
            flat, at = flat.astype(np.float32), 0
            for k in sorted(p):
                p[k], at = flat[at:at + p[k].size].reshape(p[k].shape), at + p[k].size
    final = spark.sparkContext.broadcast(p)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, waiting, out = [f.split()[0] for f in counted.split(", ")], {}, []

        def docs() -> Iterator[np.ndarray]:
            n = 0
            for batch in batches:
                for row, codes in zip(batch[names].itertuples(index=False, name=None), batch["codes"], strict=True):
                    waiting[n] = row
                    n += 1
                    yield np.frombuffer(codes, kind_of_code).astype(np.int32)

        for k, found in score_flow(shape, final.value, docs()):
            row = waiting.pop(k)
            out.append((*row[:-1], row[-1] + found / np.log(10)))
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    parts = stage(texts.select(*[f.split()[0] for f in counted.split(", ")], "codes").mapInPandas(scored, counted), "scored")
    rare = texts.select("copy", F.explode(F.arrays_zip("words", "times")).alias("w")).select("copy", "w.words", "w.times")
    rare = (rare.join(counts.select(F.col("word").alias("words"), "c"), "words")
            .groupBy("copy").agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("log_rare")))
    zero = F.lit(0.0)
    return parts.join(rare, "copy", "left").select(
        F.col("id").cast(kind).alias(id_col), "held_out", "n_tokens", (F.col("n_listed") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("log_rare", zero) - F.col("n_tokens") * float(log_base)).alias("base_score"),
        (F.col("inner") + F.coalesce("log_rare", zero)).alias("score"))
