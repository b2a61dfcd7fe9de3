"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tallyboard.llm import pieces, queries

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def ours():
    with open(MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def check(ours, library, texts):
    ids, counts = ours.encode(texts)
    decoded = ours.decode(ids, counts)
    at = 0
    for t, n, d in zip(texts, counts.tolist(), decoded):
        want = library.encode(t)
        assert ids[at:at + n].tolist() == want, repr(t[:200])
        assert d == library.decode(want), repr(t[:200])
        at += n
    assert at == len(ids)


def test_special_texts(ours, library):
    check(ours, library, ["", " ", "  ", "\n", " \n ", "a", " a", "a  b ", "▁x", "x▁▁", "<s></s><unk>", "<0x41>",
                          "\t tab\r\n", "a\x00b", "ﬁ①", "日本語𠮷野家", "é", "﻿x", "�", "12345 3.14",
                          " " * 50, "　x\xa0y", "def f(x):\n        return x\n", "ßÄé🙂🙂👩‍👩‍👧"])


def test_unbroken_texts(ours, library):
    r = random.Random(2)
    check(ours, library, ["a" * 3001, "ab" * 2000, "the" * 1500, "".join(r.choices("abcdeéñ", k=6000)),
                          "".join(r.choices("etaoin", k=9000)), "=" * 777 + "-" * 555, "日本" * 800])


def test_random_texts(ours, library):
    r = random.Random(3)
    letters = "  \n▁abcdefghinorstuéñß.,'0123日🙂ing"
    check(ours, library, ["".join(r.choices(letters, k=r.randrange(200))) for _ in range(2000)])
    vocabulary = [library.id_to_piece(i) for i in range(259, 32000)]
    check(ours, library, ["".join(r.choices(vocabulary, k=r.randrange(1, 6))) for _ in range(8000)])


def test_long_words(ours, library):
    r = random.Random(5)
    n = 300_000
    check(ours, library, ["".join(r.choices("etaoinshrdlu", k=n)), "".join(r.choices("acgt", k=n)), "=" * n, "ab" * n, "x y " + "日本語学校の" * n])


def test_rounds_of_long_words_on_short_ones(ours, library, monkeypatch):
    monkeypatch.setattr(pieces, "LONG", 3)
    r = random.Random(6)
    letters = "  \n▁abcdefghinorstuéñß.,'0123日🙂ingaaa==--"
    check(ours, library, ["".join(r.choices(letters, k=r.randrange(80))) for _ in range(2000)])
    vocabulary = [library.id_to_piece(i) for i in range(259, 32000)]
    check(ours, library, ["".join(r.choices(vocabulary, k=r.randrange(1, 12))) for _ in range(4000)])
    check(ours, library, ["a" * 3001, "the" * 1500, "=" * 777 + "-" * 555, "日本" * 800, "a \U0010ffff b"])


def test_query_equals_library_on_all_documents(spark, library):
    want = {}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(d.text or "")
        want[d.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in queries.op4_sentencepiece(spark, SF).collect()}
    assert got == want


def test_edge_rows(spark, make, library, monkeypatch):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "word " * 40_000, None), (3, "z" * 20_000, "")]
    got = {r.doc_id: r for r in pieces.encode(make(rows, "doc_id bigint, text string, ids string"), MODEL).collect()}
    assert got[1].ids == [] and got[1].decoded == "" and got[None].ids == []
    assert got[2].ids == library.encode("word " * 40_000) and got[2].decoded == "word " * 40_000
    assert got[3].ids == library.encode("z" * 20_000)
    assert pieces.encode(make([], "doc_id bigint, text string"), MODEL).count() == 0
