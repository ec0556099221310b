"""Words of texts as hashes, worked out for whole blocks of bytes."""

from __future__ import annotations

import re

import numpy as np

_TABLE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)  # a random number for each byte
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_BASE = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(text: bytes, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and where the word starts and how long it is.

    Words are split at ASCII white space, and A-Z count as a-z. A word's hash is a
    polynomial of random numbers for its bytes. Texts are worked on in blocks that
    end at white space.
    """
    out, starts, sizes, start = [], [], [], 0
    while start < len(text):
        blank = _BLANK.search(text, start + block)
        end = blank.start() if blank else len(text)
        data = np.frombuffer(text, np.uint8, end - start, start)
        letter = ~_SPACE[data]
        begins = letter & np.r_[True, ~letter[:-1]]
        first = np.flatnonzero(begins[letter])
        if len(first):
            data = data[letter]
            size = np.diff(np.r_[first, len(data)])
            place = np.arange(len(data)) - np.repeat(first, size)
            power = np.cumprod(np.full(int(size.max()), _BASE))
            out.append(np.add.reduceat(_TABLE[_LOWER[data]] * power[place], first))
            starts.append(np.flatnonzero(begins) + start)
            sizes.append(size)
        start = end
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(starts), np.concatenate(sizes)
