import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from granary.llm import byte_bpe, queries
from granary.llm.byte_bpe import Coder
from tests.llm.cases import DOCS, awkward, with_clashes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def coder():
    return Coder(PATH, public_tokenizers.PATTERN)


def merged(ranks, piece):
    """Plain merges: the lowest rank first, the leftmost of equals."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[k] + parts[k + 1], 1 << 40), k) for k in range(len(parts) - 1))
        if rank == 1 << 40:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def brute(ranks, text):
    return [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in merged(ranks, m.encode())]


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a", " a", "don't we'll 's'S''s x's", "a  b   c\n\n\n d\r\n", "tab\t\tx \n", "x  y  z　", "日本語。テキスト、a。",
    "\x1c\x1d a\x1c b\x85c", "😀👍🏽 é ﬁ ß İ", "1234567 12a ²³ ٣٤", "<|endoftext|> <|x|>", "!!'s ...'ll", "\x00\x01 \x7f",
])
def test_against_plain_merges(coder, ranks, text):
    ids = coder.encode(text)
    assert ids.tolist() == brute(ranks, text)
    assert coder.decode(ids) == text.encode()


def test_parts_of_any_size_give_the_same_ids(ranks):
    draw = random.Random(3)
    pieces = ["a", "Zed", "'s", "'", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "日", "。", "7", "٣", "é", "!", "...", "'ll", "don't", "\U0001f600"]
    for size, run in ((1, 3), (2, 2), (7, 5), (40, 9)):
        small = Coder(PATH, public_tokenizers.PATTERN, size, run)
        for _ in range(150):
            text = "".join(draw.choice(pieces) * draw.choice((1, 1, 1, 2, 12)) for _ in range(draw.randrange(1, 40)))
            assert small.encode(text).tolist() == brute(ranks, text), text


def test_long_texts(coder):
    for text in ("a" * 300_000, " " * 1_000_000 + "x", "x" + "\n" * 1_000_001, "日本" * 100_000, "'!" * 200_000, "ab 'll\n" * 100_000):
        ids = coder.encode(text)
        assert coder.decode(ids) == text.encode()
    whole = " it's 12 words,\n\nand some more 日本。" * 20_000
    assert coder.encode(whole).tolist() == coder.coder.encode_ordinary(whole)
    white = " \n" * 20_000
    assert coder.encode("a" + white + "b").tolist() == coder.coder.encode_ordinary("a" + white + "b")


def test_query_over_whole_table(spark, larger, coder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    found = {r.doc_id: r for r in queries.op13_byte_bpe(spark, larger).collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        ids = np.array(coder.coder.encode_ordinary(text), "<u4")
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows(spark, coder):
    docs = with_clashes(awkward(spark)).withColumn("ids", F.lit("extra"))
    found = docs.select("text", byte_bpe.encode(F.col("text")).alias("coded")).select("*", byte_bpe.decode(F.col("coded")).alias("back")).collect()
    assert len(found) == docs.count()
    for r in found:
        assert bytes(r.back).decode() == (r.text or "")
        assert np.frombuffer(r.coded, "<u4").tolist() == coder.coder.encode_ordinary(r.text or "")
    nothing = spark.createDataFrame([], DOCS).select(byte_bpe.encode(F.col("text")).alias("c"))
    assert nothing.collect() == []
    broken = spark.sql("select x'ff61' as text, cast(null as binary) as none")
    row = broken.select(byte_bpe.decode(byte_bpe.encode(F.col("text"))).alias("a"), byte_bpe.decode(F.col("none")).alias("b")).first()
    assert (bytes(row.a), bytes(row.b)) == ("�a".encode(), b"")
