"""Quality rules by tokeniser fertility: characters per token, byte-fallback share and token entropy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from granary.llm.common import as_bytes, small_batches
from granary.llm.vocabularies import BatchCache, byte_bpe, once_a_worker, piece_bpe, vocabulary_path
from granary.session import stage

_SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
MEASURES = ("chars_per_token", "fallback_share", "token_entropy")
#: How many quartile distances beyond the quartiles a measure may lie.
FENCES = {"chars_per_token": 4.0, "fallback_share": 4.0, "entropy_gap": 3.0}
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
# First code point of ranges of scripts.
_SCRIPTS = ((0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
            (0x0900, "Indic"), (0x0E00, "Thai"), (0x1100, "Hangul"), (0x1E00, "Latin"), (0x3040, "Kana"),
            (0x3400, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Other"))


def n_code_points(data: bytes) -> int:
    return int((np.frombuffer(data, np.uint8) & 0xC0 != 0x80).sum())


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more, its first place included."""
    n = len(words)
    if n <= width:
        return 0
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    window = number[:n - width + 1]
    for k in range(1, width):  # number pairs anew each time, so that no product overflows
        window = window * len(known) + number[k:n - width + 1 + k]
        if k < width - 1:
            window = np.unique(window, return_inverse=True)[1]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k:n - width + 1 + k] |= again
    return int(covered.sum())


def base_counts(text: bytes | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), n_code_points(b"".join(words)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def script(text: bytes | None) -> str:
    """Script of most letters of a text; ``None`` where there is none."""
    if not text:
        return "None"
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = codes[(codes >= 0xC0) | ((codes >= 0x41) & (codes <= 0x5A)) | ((codes >= 0x61) & (codes <= 0x7A))]
    if not len(letters):
        return "None"
    kind = np.searchsorted(np.array([s for s, _ in _SCRIPTS]), letters, side="right") - 1
    names = sorted({n for _, n in _SCRIPTS})
    number = np.array([names.index(n) for _, n in _SCRIPTS])
    return names[int(np.bincount(number[kind], minlength=len(names)).argmax())]


def measure(text: Column, bytes_path: str, pieces_path: str) -> Column:
    """Base counts, script and fertility of each whole text, given as bytes.

    Words are tokenised one by one: characters per token by a byte-level
    vocabulary, the share of single-byte tokens and the entropy (bits) of the
    token distribution by one with byte fallback. Texts without words have zeros.
    """

    def one(text: bytes | None, words: list[bytes], found: list[tuple]) -> tuple:
        base = base_counts(text, words)
        if not words:
            return *base, "None", 0.0, 0.0, 0.0
        counts, parts, single = zip(*found, strict=True)
        ids = np.frombuffer(b"".join(parts), "<u4")
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        return *base, script(text), base[1] / sum(counts), sum(single) / len(ids), max(0.0, float(-(share * np.log2(share)).sum()))

    def both_vocabularies() -> BatchCache:
        count, pieces = byte_bpe(bytes_path), piece_bpe(pieces_path)
        return BatchCache(lambda words: [(n, *p) for n, p in zip(count(words), pieces(words), strict=True)])

    @pandas_udf(f"{BASE}, script string, chars_per_token double, fallback_share double, token_entropy double")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = once_a_worker(("fertility", bytes_path, pieces_path), both_vocabularies)
        for whole_batch in batches:
            rows = []
            for first in range(0, len(whole_batch), 256):
                batch = [t if isinstance(t, bytes) else None for t in whole_batch.iloc[first:first + 256]]
                texts = [t.split() if t else [] for t in batch]
                rows += [one(t, words, found) for t, words, found in zip(batch, texts, known.look_up(texts), strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "script", *MEASURES])

    return measured(text)


def _length() -> Column:
    """Octaves of a text's length in tokens, from 256 on."""
    return F.log2(F.greatest(F.col("word_chars") / F.greatest("chars_per_token", F.lit(1e-9)), F.lit(1.0))) - 8


def expected_entropy(sound: DataFrame, group: str, least: int) -> DataFrame:
    """For each group the coefficients of a parabola: token entropy by length in octaves, least squares.

    A long text has more different tokens than a short one, which hides those
    that have too few or too many for their length. Groups give nine sums each;
    a group with fewer than ``least`` documents gets the parabola of all, in the
    row of the null group.
    """
    x, y = F.col("length"), F.col("token_entropy")
    sums = [F.sum(x ** k).alias(f"x{k}") for k in range(5)] + [F.sum(y * x ** k).alias(f"y{k}") for k in range(3)]
    rows = sound.withColumn("length", _length())
    all_of_them = rows.agg(F.lit(None).cast("string").alias(group), *sums)

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples():
                moments = np.array([getattr(r, f"x{k}") for k in range(5)], float)
                right = np.array([getattr(r, f"y{k}") for k in range(3)], float)
                if np.isfinite(moments).all() and moments[0] > 0:
                    left = np.array([moments[k:k + 3] for k in range(3)])
                    out.append((getattr(r, group), *np.linalg.lstsq(left, right, rcond=1e-10)[0].tolist()))
            yield pd.DataFrame(out, columns=[group, "c0", "c1", "c2"])

    found = rows.groupBy(group).agg(*sums).where((F.col("x0") >= least) & F.col(group).isNotNull()).unionByName(all_of_them)
    return found.mapInPandas(solved, f"{group} string, c0 double, c1 double, c2 double")


def with_entropy_gap(measured: DataFrame, group: str, least: int = 30) -> DataFrame:
    """``measured`` with ``entropy_gap``, the token entropy above or below what the group has at that length."""
    curves = stage(expected_entropy(measured.where(~F.col("base_failed")), group, least), "entropy-curves")
    names = ["c0", "c1", "c2"]
    every = curves.where(F.col(group).isNull()).select(*[F.col(c).alias(f"all_{c}") for c in names])
    both = measured.join(curves.where(F.col(group).isNotNull()), group, "left").join(F.broadcast(every), F.lit(True), "left")  # one row
    c0, c1, c2 = (F.coalesce(c, f"all_{c}", F.lit(0.0)) for c in names)
    x = _length()
    return both.withColumn("entropy_gap", F.col("token_entropy") - (c0 + c1 * x + c2 * x * x)).select(*measured.columns, "entropy_gap")


def bands(measured: DataFrame, group: str, fences: dict[str, float], least: int = 30, floor: float = 0.01) -> DataFrame:
    """For each group the band of every measure: quartiles widened by its fence times their distance.

    Quartiles are mergeable sketches over all documents that pass the base rule.
    A group with fewer than ``least`` such documents gets the band of all. The
    distance counts as ``floor`` at least, so that equal values don't make a
    band of no width.
    """
    def quartiles(frame):
        return frame.agg(F.count(F.lit(1)).alias("n_group"),
                         *[F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(f"q_{m}") for m in fences])

    sound = measured.where(~F.col("base_failed"))
    every = quartiles(sound).select(*[F.col(f"q_{m}").alias(f"all_{m}") for m in fences])
    own = quartiles(sound.groupBy(group))
    out = measured.select(group).distinct().join(own, group, "left").join(F.broadcast(every))  # one row
    for m, fence in fences.items():
        q = F.when(F.coalesce("n_group", F.lit(0)) >= least, F.col(f"q_{m}")).otherwise(F.col(f"all_{m}"))
        room = fence * F.greatest(q[2] - q[0], F.lit(floor))
        out = out.withColumn(f"low_{m}", q[0] - room).withColumn(f"high_{m}", q[2] + room)
    return out.select(group, *[f"{side}_{m}" for m in fences for side in ("low", "high")])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          bytes_path: str | None = None, pieces_path: str | None = None, fences: dict[str, float] | None = None, least_words: int = 50) -> DataFrame:
    """Base counts, fertility and verdict of every row of ``docs``.

    A document with fewer than ``least_words`` words, or of which over half lie
    in repeated 3-word windows, fails the base rule. The others are kept if
    characters per token, byte fallback and the entropy gap (token entropy
    against that of other texts as long) lie in the bands of their language
    (script where the language is null); ``fences`` tells how wide those are.
    Measures are staged once, one short row a document, so that the bands are
    those of all documents; the bands are staged, too, so that Spark broadcasts
    them by their size and a language of many documents isn't one task.
    Repeated rows are judged each; a null id stays null.
    """
    small_batches(docs.sparkSession)
    fences = fences or FENCES
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       measure(as_bytes(text_col), bytes_path or vocabulary_path("byte_bpe_50k.tiktoken"),
                               pieces_path or vocabulary_path("piece_bpe_32k.model")).alias("m"))
    rows = rows.select("id", "lang", "m.*")
    rows = rows.withColumn("band", F.coalesce("lang", F.concat(F.lit("script "), "script"))).withColumn(
        "base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = with_entropy_gap(stage(rows, "fertility"), "band")
    within = F.lit(True)
    for m in fences:
        within = within & F.col(m).between(F.col(f"low_{m}"), F.col(f"high_{m}"))
    return (rows.join(stage(bands(rows, "band", fences), "bands"), "band", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True)))
            .withColumnRenamed("id", id_col)
            .select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "script", *MEASURES, "entropy_gap"))
