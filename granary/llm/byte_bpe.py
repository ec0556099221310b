"""Byte-level BPE: texts to token ids and back, with the ranks of a local file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.llm.vocabularies import once_a_worker

#: White space as the library's regular expressions have it; Python's own ``\s`` has four characters more.
WHITE = "\t-\r \x85\xa0  -     　"
#: No match of the pattern spans these places: white space only begins a match, and a
#: match of letters or digits takes all that follow each other and nothing else after them.
_SAFE = re.compile(rf"(?<=[^{WHITE}\x1c-\x1f])(?=[{WHITE}])|(?<=[A-Za-z一-鿿])(?=[!-@\[-`{{-~、。])")


class Coder:
    """The tiktoken library with ranks from a file, for texts of any length.

    Texts of more than ``size`` characters are encoded in parts that end where a
    match of the pattern ends whatever stands around, so that the ids are those
    of the whole text. A part goes on to the next such place, however far that
    is. White space of ``run`` characters and more overflows the stack of the
    library's regular expressions, so what the pattern makes of it is cut by hand: all
    of it at the end of a text, else all but the last character, is one match.
    """

    def __init__(self, path: str, pattern: str, size: int = 1 << 16, run: int = 4096):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("ranks of a file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size, self.run = size, run
        self.long_run = re.compile(rf"[{WHITE}]{{{run},}}")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without special tokens."""
        if len(text) < self.run:
            return np.array(self.coder.encode_ordinary(text), "<u4")
        out, at = [], 0
        for white in self.long_run.finditer(text):
            out += self._in_parts(text, at, white.start())
            at = white.end() if white.end() == len(text) else white.end() - 1
            out.append(np.array(self.coder._encode_single_piece(text[white.start():at]), "<u4"))
        out += self._in_parts(text, at, len(text))
        return np.concatenate(out) if out else np.empty(0, "<u4")

    def _in_parts(self, text: str, start: int, end: int) -> Iterator[np.ndarray]:
        while start < end:
            cut = _SAFE.search(text, start + self.size, end) if end - start > self.size else None
            stop = cut.start() if cut else end
            yield np.array(self.coder.encode_ordinary(text[start:stop]), "<u4")
            start = stop

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for; an id the ranks don't have raises KeyError."""
        step = 1 << 20
        return b"".join(self.coder.decode_bytes(ids[k:k + step].tolist()) for k in range(0, len(ids), step))


def _coder(path: str | None, pattern: str | None):
    import public_tokenizers

    place, split = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return lambda: once_a_worker(("byte_bpe", place, split), lambda: Coder(place, split))


def encode(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """Token ids of a text column, as little-endian unsigned 32-bit integers in a binary.

    Whole texts are encoded, of any length; a null or empty text has no ids (an
    empty binary). Bytes that aren't UTF-8 count as U+FFFD. Every row is coded
    for itself, so repeated rows, ties, an empty table and other columns have no
    effect. Hand texts over in small batches (:func:`granary.llm.common.small_batches`).
    """
    coder = _coder(path, pattern)

    @F.pandas_udf("binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder()
        for texts in batches:
            yield pd.Series([own.encode((t or b"").decode("utf-8", "replace")).tobytes() for t in texts], dtype=object)

    return coded(text.cast("binary"))


def decode(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The raw bytes of token ids as :func:`encode` gives them; null or no ids give an empty binary.

    Bytes and not text: a token may end within a character.
    """
    coder = _coder(path, pattern)

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder()
        for rows in batches:
            yield pd.Series([own.decode(np.frombuffer(ids or b"", "<u4")) for ids in rows], dtype=object)

    return decoded(ids)
