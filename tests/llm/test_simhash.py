"""Fingerprints and classes against a plain reading of the definition."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyboard.llm import common, queries, simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def plain_classes(fps):
    """Smallest id reachable over links of at most two bits; fps: (id, fingerprint)."""
    least = {f: min(i for i, g in fps if g == f) for f in {f for _, f in fps}}
    root = dict(zip(least, least))
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    best = {}
    for f, r in root.items():
        best[r] = min(best.get(r, least[f]), least[f])
    return [(i, f"{f:016x}", best[root[f]]) for i, f in fps]


def test_fingerprint_cases():
    long = " ".join(random.Random(1).choices(["Ab", "cdÉ", " x", "\x1cy", "z" * 300], k=5000))
    for text in [None, "", " \t\x0b\x0c\r\n", "One", "one TWO", "a b c", "a b c a b c", "x y z w", long]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_hash_is_spark_xxhash64(spark):
    rows = spark.createDataFrame([("a",), ("héllo wörld " * 9,)], "s string").select("s", F.xxhash64("s"))
    assert all(xxhash.xxh64_intdigest(s.encode(), 42) == h % (1 << 64) for s, h in rows.collect())


def test_query_on_all_documents(spark):
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op10_simhash(spark, SF).collect()))
    assert got == sorted(plain_classes(docs))
    assert len({c for _, _, c in got}) < len(got)


@pytest.mark.parametrize("place_size", [1, 4, 1024])
def test_links_of_crowded_places(spark, place_size):
    r = random.Random(5)
    center, far = r.getrandbits(64), r.getrandbits(64)
    fps = {center, 0, far}
    while len(fps) < 120:
        f = center
        for _ in range(r.randrange(5)):
            f ^= 1 << r.randrange(64)
        fps.add(f)
    signed = [simhash._signed(f) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = {f: root for f, root in simhash.roots(nodes, 2, place_size).collect()}
    want = {}
    for i, _, c in plain_classes([(s, f) for s, f in zip(signed, fps)]):
        want[i] = c
    assert got == want


def test_long_chain(spark):
    chain = [0]
    for i in range(0, 60, 2):
        chain.append(chain[-1] ^ (3 << i))
    nodes = spark.createDataFrame([(f,) for f in chain], "fp bigint")
    assert {r for _, r in simhash.roots(nodes).collect()} == {0}


ROWS = [(1, "a b c d e"), (2, "A B C d e"), (None, "a b c d e"), (5, None), (4, ""), (7, "un autre texte tout seul"),
        (7, "un autre texte tout seul"), (None, "nameless words here only"), (None, "nameless words here only")]


def test_edge_rows(spark, make):
    got = [tuple(r) for r in simhash.classes(make(ROWS, "doc_id bigint, text string")).collect()]
    by_text = {t: {c for i, f, c in got if f == f"{plain_fingerprint(t):016x}"} for _, t in ROWS}
    assert by_text["a b c d e"] == {1} and by_text[None] == {4} and by_text["nameless words here only"] == {None}
    assert len(got) == len(ROWS)


def test_keep_one(spark, make):
    rows = [(i, t, "x", "y") for i, t in ROWS]
    docs = make(rows, "doc_id bigint, text string, fp string, `component_id.x` string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=repr) == sorted(
        [(1, "a b c d e"), (4, ""), (7, "un autre texte tout seul"), (None, "nameless words here only")], key=repr)


def test_rows_by_bitmaps(spark, monkeypatch):
    r = random.Random(8)
    parts = [0, 1, 5, 70_000]
    numbers = [(p << 33) + i for p in parts for i in (*range(300), 32_767, 32_768, 65_535, 65_536, 99_999)]
    stay = sorted({*r.sample(numbers, 600), numbers[0], numbers[-1]})
    rows = spark.createDataFrame([(n, f"t{n}") for n in numbers], "n bigint, bits string")
    kept = spark.createDataFrame([(n,) for n in stay], "n bigint")

    def got():
        return simhash.numbered_rows(rows, kept, "n")
    assert got().columns == rows.columns
    assert sorted(map(tuple, got().collect())) == [(n, f"t{n}") for n in stay]
    assert "ExistenceJoin" not in got()._jdf.queryExecution().toString() and "LeftSemi" not in got()._jdf.queryExecution().toString()
    assert simhash.numbered_rows(rows, kept.limit(0), "n").count() == 0
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    assert "LeftSemi" in got()._jdf.queryExecution().toString()
    assert sorted(map(tuple, got().collect())) == [(n, f"t{n}") for n in stay]


def test_empty(spark, make):
    docs = make([], "doc_id bigint, text string")
    assert simhash.classes(docs).count() == 0 and simhash.keep_one(docs).count() == 0
