"""Best-fit packing: pieces of documents into sequences under several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import as_bytes, small_batches
from granary.llm.vocabularies import TokenTable, once_a_worker, vocabulary_path
from granary.session import stage

PIECE = "piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most; attention cost is the sum of squared lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], float)


def cut(ids: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Pieces of a document's ids (4 bytes each): number, start, length and crc32 of the bytes."""
    return [(k, at // 4, len(part := ids[at:at + 4 * size]) // 4, zlib.crc32(part)) for k, at in enumerate(range(0, len(ids), 4 * size))]


def pieces(docs: DataFrame, size: int = 2048, end: int = 0, path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise whole texts, end each with ``end`` and cut what is longer than ``size``.

    A null or empty text has the end token only. Repeated rows each give their
    pieces, told apart by the column ``copy``.
    """
    small_batches(docs.sparkSession)
    place = path or vocabulary_path("word_bpe_49k.json")

    def tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = once_a_worker(("word_bpe", place), lambda: TokenTable(place))
        last = np.array([end], "<u4").tobytes()
        for whole_batch in batches:
            for first in range(0, len(whole_batch), 500):
                batch, rows = whole_batch.iloc[first:first + 500], []
                found = table.ids([t if isinstance(t, bytes) else b"" for t in batch["text"]])
                for doc, copy, ids in zip(batch["id"], batch["copy"], found, strict=True):
                    rows += [(doc, copy, *p) for p in cut(ids + last, size)]
                yield pd.DataFrame(rows, columns=["id", "copy", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.monotonically_increasing_id().alias("copy"), as_bytes(text_col).alias("text"))
    return rows.mapInPandas(tokenised, f"id string, copy long, {PIECE}").withColumn("id", F.col("id").cast(kind))


def best_fit(lengths: np.ndarray, capacity: Capacity, weights: tuple[float, float, float]) -> tuple[np.ndarray, int]:
    """Bin of each length, and the number of bins.

    Lengths are placed from the longest on. Of the bins with room in every
    capacity, the one with the smallest weighted norm of what would be left is
    taken, the oldest of equals; a new bin is opened where none has room.
    """
    limit = capacity.vector()
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1) / limit
    weight, eps = np.array(weights, float), 1e-9
    place, opened = np.empty(len(lengths), np.int64), 0
    room, names, held = np.empty((1024, 3)), np.empty(1024, np.int64), 0
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    least = lengths.min() / limit[0] if len(lengths) else 0.0
    for step, k in enumerate(order):
        need = demand[k]
        if (need > 1 + eps).any():
            raise ValueError("a piece is larger than a sequence")
        left = room[:held] - need
        fits = np.flatnonzero((left >= -eps).all(axis=1))
        if len(fits):
            at = fits[((left[fits] * weight) ** 2).sum(axis=1).argmin()]
            room[at] = left[at]
        else:
            if held == len(room):
                room, names = np.concatenate([room, np.empty_like(room)]), np.concatenate([names, np.empty_like(names)])
            at, held = held, held + 1
            room[at], names[at], opened = 1 - need, opened, opened + 1
        place[k] = names[at]
        if step % 256 == 255:  # bins without room for the shortest piece are done with
            keep = (room[:held, 0] >= least - eps) & (room[:held, 1] >= 1 / limit[1] - eps)
            count = int(keep.sum())
            room[:count], names[:count], held = room[:held][keep], names[:held][keep], count
    return place, opened


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
         block: int = 16_384) -> DataFrame:
    """Give each piece a sequence and a gapless place in it.

    Pieces are dealt out by hash to tasks of a few blocks, and each block is
    packed by itself, so that work and memory a task stay the same however many
    pieces there are. What is lost to the split is at most the last bins of a
    block. Sequence numbers hold the task's number and are not consecutive.
    """
    staged = stage(pieces, "pieces")
    tasks = max(1, -(-staged.count() // (2 * block)))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, held = TaskContext.get().partitionId() << 40, pd.DataFrame()
        for batch in batches:
            held = pd.concat([held, batch], ignore_index=True) if len(held) else batch
            while len(held) >= block:
                out, n = in_sequences(held.iloc[:block])
                yield out.assign(sequence_id=out["sequence_id"] + opened)
                opened, held = opened + n, held.iloc[block:]
        if len(held):
            out, _ = in_sequences(held)
            yield out.assign(sequence_id=out["sequence_id"] + opened)

    def in_sequences(rows: pd.DataFrame) -> tuple[pd.DataFrame, int]:
        bins, n = best_fit(rows["length"].to_numpy(), capacity, weights)
        out = rows.assign(sequence_id=bins).sort_values(["sequence_id", "length", "copy", "piece"], kind="stable")
        return out.assign(offset=out.groupby("sequence_id")["length"].cumsum() - out["length"]), n

    key = F.xxhash64("copy", "piece")
    kind = pieces.schema["id"].dataType.simpleString()
    dealt = staged.withColumn("id", F.col("id").cast("string")).repartition(tasks, key).sortWithinPartitions(key, "copy", "piece")
    return (dealt.mapInPandas(packed, f"id string, copy long, {PIECE}, sequence_id long, offset long")
            .withColumn("id", F.col("id").cast(kind)).drop("copy"))


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), end: int = 0, path: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack all rows of ``docs``."""
    out = pack(pieces(docs, capacity.tokens, end, path, id_col, text_col), capacity)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
