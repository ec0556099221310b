"""Public vocabularies, applied word by word with a cache of bounded size."""

from __future__ import annotations

import base64
import re
import sys
import types
from array import array
from collections.abc import Callable

import numpy as np

from granary.llm.words import word_hashes


class WordCache(dict):
    """What ``make`` gives for a word, remembered for the latest ``limit`` to ``2 * limit`` distinct words.

    When the cache is full it becomes the old one, which words are taken from
    that come again; so frequent words are never made anew.
    """

    def __init__(self, make: Callable[[bytes], object], limit: int = 200_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: bytes) -> object:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        self[word] = found
        return found


class BatchCache:
    """As WordCache, for words that are made many at a time: ``make`` takes a list of words."""

    def __init__(self, make: Callable[[list[bytes]], list], limit: int = 250_000):
        self.make, self.limit, self.known, self.old = make, limit, {}, {}

    def look_up(self, texts: list[list[bytes]]) -> list[list]:
        """What belongs to each word of each text."""
        if len(self.known) >= self.limit:
            self.known, self.old = {}, self.known
        found = [list(map(self.known.get, words)) for words in texts]
        missing = {w for words, f in zip(texts, found, strict=True) if None in f for w, x in zip(words, f, strict=True) if x is None}
        if not missing:
            return found
        self.known.update((w, self.old[w]) for w in missing & self.old.keys())
        made = list(missing - self.old.keys())
        self.known.update(zip(made, self.make(made), strict=True))
        return [[self.known[w] if x is None else x for w, x in zip(words, f, strict=True)] if None in f else f
                for words, f in zip(texts, found, strict=True)]


def once_a_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept as long as the Python worker lives, which serves one task after the other.

    Functions of this package reach the workers by value, so the package's own
    globals are new to each task; a module of the worker's is not.
    """
    held = sys.modules.setdefault("_granary_worker", types.ModuleType("_granary_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def vocabulary_path(name: str) -> str:
    """Place of a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


_MARKS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_STOPPED = re.compile(rb"(.*[a-z\x80-\xff])([!-/:-@\[-`{-~]+)", re.DOTALL)


def _stem_and_marks(word: bytes) -> tuple[bytes, bytes] | None:
    """A word cut before the ASCII marks at its end, if a letter comes before them; marks after a letter are a token run of their own."""
    found = _STOPPED.fullmatch(word) if word[-1] in _MARKS and b"<|" not in word else None
    if found is None:
        return None
    stem, marks = found.groups()
    if stem[-1] >= 0x80:
        last = stem[-4:].decode("utf-8", "replace")[-1]
        if not (last.lower().isalpha() and last < "\u0590"):  # Latin, Greek, Cyrillic: letters to every Unicode version
            return None
    return stem, marks


# Byte-level vocabularies write each byte as a letter: these bytes as themselves, the others as letters from U+0100 on.
_SELVES = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SELVES)}


def _letters(text: str) -> str | None:
    """A word of Latin letters as the vocabulary has it, in lower case and by bytes; ``None`` for any other.

    Below U+0250 nothing is composed anew, and lower case knows no context.
    """
    if text.isascii():
        return text.lower() if text.isalpha() else None
    if not max(text) < "\u0250" or not (lower := text.lower()).isalpha():
        return None
    return lower.encode().decode("latin-1").translate(_BYTE_LETTERS)


def word_bpe(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Token ids of each of many words, as little-endian unsigned 32-bit numbers.

    The vocabulary's pre-tokenizer ends a token at white space, so a text's ids
    are those of its words one after the other. Words of Latin letters only need
    none of the rules for splitting: they are given to the vocabulary's own merges
    as one text, which is faster: each ends with its only token that ends a word.
    Marks at a word's end are tokens of their own, which are looked up apart from
    what stands before them.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    merges = Tokenizer(tokenizer.model)
    merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    ends_word = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    ends_word[[k for token, k in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(texts: list[str], by: Tokenizer = tokenizer) -> list[list[int]]:
        return [f.ids for f in by.encode_batch_fast(texts, add_special_tokens=False)]

    tails: dict[bytes, bytes] = {}

    def of_tail(marks: bytes) -> bytes:
        found = tails.get(marks)
        if found is None:
            if len(tails) >= 10_000:
                tails.clear()
            found = tails[marks] = array("I", encode([marks.decode()])[0]).tobytes()
        return found

    def ids(words: list[bytes]) -> list[bytes]:
        cut = {w: parts for w in words if w[-1] in _MARKS and (parts := _stem_and_marks(w))}
        wanted = list({cut[w][0] if w in cut else w for w in words})
        texts = [w.decode("utf-8", "replace") for w in wanted]
        letters = list(map(_letters, texts))
        plain = [k for k, t in enumerate(letters) if t]
        out: dict[bytes, bytes] = {}
        for start in range(0, len(plain), 1000):
            part = plain[start:start + 1000]
            whole = np.array(encode([" ".join([letters[k] for k in part])], merges)[0], "<u4")
            edges = [0, *(4 * np.flatnonzero(ends_word[whole]) + 4).tolist()]
            if len(edges) == len(part) + 1:
                data = whole.tobytes()
                out.update(zip([wanted[k] for k in part], [data[a:b] for a, b in zip(edges, edges[1:], strict=False)], strict=True))
        rest = [k for k, w in enumerate(wanted) if w not in out]
        out.update((wanted[k], array("I", f).tobytes()) for k, f in zip(rest, encode([texts[k] for k in rest]), strict=True))
        return [out[cut[w][0]] + of_tail(cut[w][1]) if w in cut else out[w] for w in words]

    return ids


class TokenTable:
    """Token ids of texts by ``word_bpe``; distinct words are looked up by hash, for many texts at a time.

    The ids of the latest ``limit`` to ``2 * limit`` distinct words are remembered.
    """

    def __init__(self, path: str, limit: int = 250_000):
        self.make, self.limit, self.known, self.old = word_bpe(path), limit, {}, {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers.

        The vocabulary is in lower case, so capitals don't change ids, but for
        special tokens: a text in which one may stand goes word by word.
        """
        special = {k: b"".join(self.make(t.split())) for k, t in enumerate(texts) if b"<|" in t}
        texts = [b"" if k in special else t for k, t in enumerate(texts)]
        whole = b"\n".join(texts)
        hashes, starts, sizes = word_hashes(whole)
        if not len(hashes):
            return [special.get(k, b"") for k in range(len(texts))]
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._look_up(distinct, first, whole, starts, sizes)
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        every, offset = np.frombuffer(b"".join(found), "<u4"), np.cumsum(length) - length
        of_word = length[place]
        until = np.cumsum(of_word)
        ids = every[np.arange(until[-1]) + np.repeat(offset[place] - (until - of_word), of_word)]
        edges = np.cumsum([len(t) + 1 for t in texts])
        ends = np.r_[0, until][np.searchsorted(starts, edges)].tolist()
        return [special[k] if k in special else ids[a:b].tobytes() for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False))]

    def _look_up(self, distinct: np.ndarray, first: np.ndarray, whole: bytes, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        if len(self.known) >= self.limit:
            self.known, self.old = {}, self.known
        keys = distinct.tolist()
        found = list(map(self.known.get, keys))
        missing = [k for k, f in enumerate(found) if f is None]
        for k, f in zip(missing, map(self.old.get, [keys[k] for k in missing]), strict=True):
            found[k] = f
        new = [k for k in missing if found[k] is None]
        begin, end = starts[first[new]], (starts + sizes)[first[new]]
        made = self.make([whole[a:b].lower() for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
        for k, f in zip(new, made, strict=True):
            found[k] = f
        self.known.update((keys[k], found[k]) for k in missing)
        return found


def byte_bpe(path: str) -> Callable[[list[bytes]], list[int]]:
    """Number of tokens of each of many words with the space before it, in a byte-level vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda words: [len(coder.encode_ordinary(" " + w.decode("utf-8", "replace"))) for w in words]


def piece_bpe(path: str) -> Callable[[list[bytes]], list[tuple[bytes, int]]]:
    """Of each of many words, the token ids (as word_bpe) and how many of them are single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    single = {k for k in range(model.vocab_size()) if model.is_byte(k) or model.is_unknown(k)}

    def ids(words: list[bytes]) -> list[tuple[bytes, int]]:
        found = model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1) if words else []
        return [(array("I", f).tobytes(), sum(map(single.__contains__, f))) for f in found]

    return ids
