"""Ids and bytes against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyboard.llm import bytepairs, queries

SF = "/root/testdata/sf0.001"
RANKS = bytepairs.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
LONG_RUNS = ["a" * 900, "x" * 300 + " 'll " + "\n" * 500 + "y", "=" * 777 + "1" * 555 + "日本" * 400, "  " * 400 + "it'll" * 90]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def ours():
    return bytepairs.Encoder(RANKS, PATTERN)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def some_texts(n):
    r = random.Random(n)
    letters = ["a", "b", "the", "'", "ll", "'re", " ", "  ", "\n", "\t", "1", "9", "é", "日", "🙂", ".", "!!", "　", "\x1c", "<|endoftext|>", "\r\n"]
    return ["".join(r.choices(letters, k=r.randrange(150))) for _ in range(n)]


def test_texts_equal_library(ours, library):
    for t in ["", " ", "\n", " \n ", *some_texts(2000), *LONG_RUNS]:
        assert ids(ours.encode_text(t)) == library.encode_ordinary(t), repr(t[:100])


def test_every_character_equals_library(ours, library):
    for c in [*range(0, 0x3000), *range(0x1f000, 0x1ff00)]:
        t = f"a{chr(c)}1 {chr(c)}{chr(c)} x"
        assert ids(ours.encode_text(t)) == library.encode_ordinary(t), hex(c)


def test_unbroken_texts_equal_library(ours, library):
    r = random.Random(5)
    for t in ["a" * 3000, "ab" * 2000, "".join(r.choices("etaoin", k=9000)), "é" * 2500, "".join(r.choices("日本語", k=1500))]:
        assert ids(ours.encode_text(t)) == library.encode_ordinary(t)


@pytest.mark.parametrize("chunk, overlap", [(16, 5), (40, 16), (64, 64), (300, 100)])
def test_stitched_chunks_equal_library(spark, library, chunk, overlap):
    """Chunks far shorter than runs of letters or blanks, so that many pairs have no common end at first."""
    texts = some_texts(150) + LONG_RUNS
    found = bytepairs.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), RANKS, PATTERN, chunk=chunk, overlap=overlap)
    got = {r.doc_id: r for r in bytepairs.decode(found, RANKS).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert ids(got[i].ids) == library.encode_ordinary(t), repr(t[:100])
        assert got[i].decoded == t.encode()


def test_a_pattern_with_gaps_is_refused():
    with pytest.raises(ValueError, match="every character"):
        bytepairs.Encoder(RANKS, r"\p{L}+").encode_text("a b")
    with pytest.raises(ValueError, match="single bytes"):
        bytepairs.Encoder({b"a": 0}, PATTERN)


def test_query_equals_library_on_all_documents(spark, library):
    want = {}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        tokens = library.encode_ordinary(d.text or "")
        want[d.doc_id] = (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(library.decode_bytes(tokens)).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in queries.op12_bytepairs(spark, SF).collect()} == want


def test_edge_rows(spark, make, library):
    long = "some words, and more. " * 20_000
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, long, None), (2, long, None), (None, long, ""), (3, "z" * 200_000, "")]
    found = bytepairs.encode(make(rows, "doc_id bigint, text string, ids string"), RANKS, PATTERN)
    got = sorted((r.doc_id is None, r.doc_id or 0, ids(r.ids)) for r in found.collect())
    words, run = library.encode_ordinary(long), library.encode_ordinary("z" * 200_000)
    assert got == sorted([(False, 1, []), (False, 1, []), (True, 0, []), (False, 2, words), (False, 2, words), (True, 0, words), (False, 3, run)])
    array = found.where("doc_id = 2").select(bytepairs.id_array(found.ids).alias("a")).first().a
    assert array == words
    empty = bytepairs.encode(make([], "doc_id string, text string"), RANKS, PATTERN)
    assert bytepairs.digests(bytepairs.decode(empty, RANKS)).count() == 0
