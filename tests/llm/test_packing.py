import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from granary.llm import packing, vocabularies
from granary.llm.packing import Capacity, best_fit
from granary.llm.vocabularies import TokenTable, vocabulary_path
from tests.llm.cases import DOCS, awkward, with_clashes


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))


def check(found, texts, tokenizer, size=2048):
    """Pieces are those of the texts, and sequences are gapless and within their size."""
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected = [(k, at, len(ids[at:at + size]), zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), size))]
        assert sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in by[doc]}) == expected
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(held)


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.pack_documents(docs).collect()
    n = check(found, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert n <= -(-sum(r.length for r in found) // 2048) + 1


def test_awkward_rows(spark, tokenizer):
    docs = with_clashes(awkward(spark))
    found = packing.pack_documents(docs).collect()
    check(found, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert sum(r.doc_id == 7 for r in found) == 2  # repeated rows are both packed
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("text", [
    "A.B, c. <|endoftext|>x <|ENDOFTEXT|>", "don't. It's, İ. É, x.\ty,\x0bz hi! a!b ! !!", "日本。 a。. ...b, 3., 4.5. ! x",
    "ſs. K, a\xa0b. c, ́x. a ́b", "\x1c x\x1fy. \x85 z,", "",
])
def test_ids_of_words_are_those_of_the_text(tokenizer, text):
    table = TokenTable(vocabulary_path("word_bpe_49k.json"), limit=2)  # so small that words are forgotten
    for texts in ([text], ["a b", text, "", "c. d", text]):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in table.ids([t.encode() for t in texts])]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("capacity", [Capacity(), Capacity(documents=3), Capacity(attention=2048 * 600)])
def test_every_capacity_holds(capacity):
    draw = np.random.default_rng(4)
    lengths = draw.integers(1, 500, 3000)
    place, n = best_fit(lengths, capacity, (1.0, 0.5, 0.5))
    tokens = np.bincount(place, weights=lengths, minlength=n)
    assert (tokens <= capacity.tokens).all() and (tokens > 0).all()
    assert (np.bincount(place, minlength=n) <= capacity.documents).all()
    assert (np.bincount(place, weights=lengths.astype(float) ** 2, minlength=n) <= capacity.attention + 1e-3).all()
    bound = max(lengths.sum() / capacity.tokens, len(lengths) / capacity.documents, (lengths.astype(float) ** 2).sum() / capacity.attention)
    assert n <= 1.12 * bound + 1


def test_a_piece_too_large():
    with pytest.raises(ValueError):
        best_fit(np.array([10]), Capacity(tokens=5), (1.0, 0.0, 0.0))
    assert best_fit(np.array([], int), Capacity(), (1.0, 0.0, 0.0))[1] == 0


@pytest.mark.parametrize("capacity,sequences", [
    (Capacity(100, 4, 100 * 100), 15),  # 60 pieces of 10 tokens: 4 documents each, not 10
    (Capacity(100, 100, 500), 12),  # 5 pieces of attention cost 100 each
])
def test_capacities_other_than_tokens_bind(spark, capacity, sequences):
    pieces = spark.createDataFrame([(k, k, 0, 0, 10, 0) for k in range(60)], f"id long, copy long, {packing.PIECE}")
    held = defaultdict(list)
    for r in packing.pack(pieces, capacity).collect():
        held[r.sequence_id].append(r.length)
    assert len(held) == sequences
    assert all(len(x) <= capacity.documents and sum(n * n for n in x) <= capacity.attention for x in held.values())


def test_words_of_letters_and_marks_are_looked_up_apart(tokenizer):
    """Latin letters go to the merges alone and marks at the end by themselves; whatever a mark may join stays whole."""
    cut, letters = vocabularies._stem_and_marks, vocabularies._letters
    assert cut("redhe$$$".encode()) == (b"redhe", b"$$$") and cut("été,###".encode()) == ("été".encode(), b",###")
    assert cut("aİ.".encode()) is None and cut("日.".encode()) is None and cut(b"x<|.") is None and cut(b"3.") is None
    assert letters("Redhe") == "redhe" and letters("é") == "Ã©" and letters("İ") is letters("日") is letters("a1") is letters("") is None
    words = [w.encode() for w in "redhe$$$ été,### aİ. İ,' K!! Åb Straße ÀñŞ don't. x's, ς. Σας ǅ!! naïve&& 日本. 2.0. a.b ﬁx ª º² à-b,".split()]
    wanted = [np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert vocabularies.word_bpe(vocabulary_path("word_bpe_49k.json"))(words) == wanted
