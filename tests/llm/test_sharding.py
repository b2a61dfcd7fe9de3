"""Shards of the interleaving: counts, mixture, reruns, and equality with SQL."""

import zlib
from collections import Counter

from tallyboard.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(equals_sql):
    equals_sql("op8_sharding")


def test_plan_has_no_python(spark, plan):
    text = plan(queries.op8_sharding(spark, SF))
    assert "Python" not in text and "Arrow" not in text


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "concat('text ', id % 7) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 9) END AS source")
    got = sharding.assign(docs.repartition(13), 37, keep=["source"]).collect()
    counts, sources = Counter(r.shard for r in got), Counter(r.source for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(37))
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    inside = Counter((r.shard, r.source) for r in got)
    for (shard, source), n in inside.items():
        assert abs(n - sources[source] / 37) <= 2
    assert all(r.text_crc32 == zlib.crc32(f"text {r.doc_id % 7}".encode()) and r.size == 22 for r in got)
    again = sharding.assign(docs.repartition(5), 37, keep=["source"]).collect()
    assert sorted(got, key=lambda r: r.doc_id) == sorted(again, key=lambda r: r.doc_id)


def test_edge_rows(spark, make):
    same = [(3, "again", "s", 1, "x")] * 30
    docs = make([(1, None, "s", 1, "x"), (None, "", None, 2, None), (2, "ü" * 50_000, "", 3, "y"), *same],
                "doc_id bigint, text string, source string, shard int, `size` string")
    got = sharding.assign(docs, 4).collect()
    assert len(got) == 33 and set(got[0].asDict()) == {"doc_id", "size", "text_crc32", "shard", "slot"}
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].size == 16 and by_id[1].text_crc32 == 0 and by_id[2].size == 100_016
    assert sorted(Counter(r.shard for r in got).values()) == [8, 8, 8, 9]
    assert sharding.assign(docs.limit(0), 4).count() == 0
    assert sorted((r.shard, r.slot) for r in sharding.assign(docs.limit(2), 4).collect()) == [(0, 0), (2, 0)]
