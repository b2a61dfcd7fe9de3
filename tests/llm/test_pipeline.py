"""Every stage against a plain version on its own input, and edge rows through all stages."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from tallyboard.llm import language as L
from tests.llm import test_mixing, test_pseudonyms, test_simhash

SF = "/root/testdata/sf0.001"


def plain_prediction(network, text):
    """Mean over overlapping windows of a convolution written out with einsum."""
    data = np.frombuffer(text.encode(), np.uint8)
    total, weight = 0, 0
    step = L.WINDOW - max(L.WIDTHS) + 1
    starts = range(0, max(1, len(data) - (L.WINDOW - step)), step)
    for a in starts:
        piece = network.embedding[data[a:a + L.WINDOW]]
        features = []
        for w in L.WIDTHS:
            room = np.concatenate([piece, np.zeros((max(0, w - len(piece)), piece.shape[1]))])
            view = np.lib.stride_tricks.sliding_window_view(room, w, axis=0)
            features.append(np.maximum(np.einsum("pew,wef->pf", view, network.filters[w]).max(axis=0) + network.bias[w], 0))
        z = np.concatenate(features) @ network.dense + network.offset
        p = np.exp(z - z.max())
        total, weight = total + len(piece) * p / p.sum(), weight + len(piece)
    return total / weight


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before and after each stage, as the stages hand them on."""
    spark.conf.set("spark.tallyboard.pseudonymKey", test_pseudonyms.KEY)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    from tallyboard.session import scratch_table
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch_table(stage(spark, docs, SF), "stage")
        out.append(docs.collect())
    spark.conf.unset("spark.tallyboard.pseudonymKey")
    return out


def test_stages(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "personal data", "mixture", "token ids"]
    assert all(set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for rows in steps[:-1])
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_language_stage(spark, steps):
    network = L.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    want = [r for r in steps[0] if re.search(r"[^\W\d_]", r.text) and plain_prediction(network, r.text).max() >= corpus_pipeline.MIN_SCORE]
    assert sorted(map(tuple, steps[1])) == sorted(map(tuple, want)) and len(want) > 0.98 * len(steps[0])


def test_near_duplicate_stage(steps):
    rows = steps[1]
    classes = {i: c for i, _, c in test_simhash.plain_classes([(r.doc_id, test_simhash.plain_fingerprint(r.text)) for r in rows])}
    assert sorted(map(tuple, steps[2])) == sorted(tuple(r) for r in rows if classes[r.doc_id] == r.doc_id)
    assert len(steps[2]) < len(rows)


def test_personal_data_stage(steps):
    want = []
    for r in steps[2]:
        new = test_pseudonyms.plain_text(r.text)
        want.append((r.doc_id, new, r.lang, r.source, len(new)))
    assert sorted(map(tuple, steps[3])) == sorted(want) and any(a != tuple(b) for a, b in zip(sorted(want), sorted(steps[2])))


def test_mixture_stage(steps):
    before, after = {tuple(r) for r in steps[3]}, Counter(tuple(r) for r in steps[4])
    assert set(after) <= before and max(after.values()) <= 3
    size = {r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in before}
    sources = sorted({r[3] for r in before})
    sizes = [sum(size[r] for r in before if r[3] == s) for s in sources]
    for s, goal in zip(sources, test_mixing.plain_targets(sizes)):
        taken = sum(n * size[r] for r, n in after.items() if r[3] == s)
        assert abs(taken - goal) <= max(size[r] for r in before if r[3] == s) / 2


def test_token_stage(steps):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in steps[4]:
        ids = library.encode(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, steps[5])) == sorted(want)


def test_run_and_edge_rows(spark, make, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, `fp.x` int, ids string"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the words of a nameless text", None, None, 5),
            (3, "the words of a text", "en", "s", 5), (3, "the words of a text", "en", "s", 5), (4, "les mots d'un texte", "fr", "é", 5),
            (5, "word " * 60_000, "en", "s", 5), (6, "12 34", "en", "s", 5)]
    make([(*r, "x", 1, None) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {None, 3, 4, 5} and Counter(r.doc_id for r in got)[3] <= 3
    make([], schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_language_stage_without_labels(spark, make):
    docs = make([(1, "the words", None, "s"), (2, "12 34", None, "s"), (3, None, None, "s")], "doc_id bigint, text string, lang string, source string")
    assert [r.doc_id for r in corpus_pipeline.identified(spark, docs, SF).collect()] == [1]


def test_least_score():
    assert corpus_pipeline.least_score(4) == pytest.approx(corpus_pipeline.MIN_SCORE) and corpus_pipeline.least_score(1) == 1
    for n in range(2, 50):
        assert 1 / n < corpus_pipeline.least_score(n) < corpus_pipeline.least_score(n - 1)


def test_language_stage_rejects_symbols(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(1)
    junk = ["a" + "".join(rng.choice(list("!#$%&()*+,-./0123456789<>=[]{}|~"), 1_000)) for _ in range(100)]
    more = spark.createDataFrame([(-1 - i, t, None, "s", 1_001) for i, t in enumerate(junk)], docs.schema)
    kept = [r.doc_id for r in corpus_pipeline.identified(spark, docs.unionByName(more), SF).select("doc_id").collect()]
    assert sum(i < 0 for i in kept) <= 20 and sum(i >= 0 for i in kept) > 0.98 * docs.count()
