"""Joins whose small side is beyond the broadcast bound give the same rows as below it."""

import pytest

from tallyboard.llm import common, mixing, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """No side is small enough: neither for the hint, nor for run-time planning."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}

    def switch():
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", -1)
        for k in before:
            spark.conf.set(k, "-1")
    yield switch
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["op8_sharding", "op9_warc"])
def test_queries_with_sql(equals_sql, no_broadcast, name):
    no_broadcast()
    equals_sql(name)


@pytest.mark.parametrize("name", ["op10_simhash", "op6_mixing"])
def test_queries_without_sql(spark, no_broadcast, name):
    want = sorted(map(tuple, queries.QUERIES[name](spark, SF).collect()))
    no_broadcast()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(map(tuple, got.collect())) == want
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text


def test_one_document_of_each_class(spark, no_broadcast):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(r.doc_id for r in simhash.keep_one(docs, shingle=3, max_bits=2).collect())
    no_broadcast()
    assert sorted(r.doc_id for r in simhash.keep_one(docs, shingle=3, max_bits=2).collect()) == want
    assert 0 < len(want) < docs.count()


def test_repeated_rows_of_the_mix(spark, no_broadcast):
    docs = spark.range(3_000).selectExpr("if(id % 2 = 0, 7, id) AS doc_id", "if(id % 2 = 0, 'same row', 'w w w') AS text", "if(id % 7 = 3, 'b', 'a') AS source")

    def mixed():
        return sorted(map(tuple, mixing.mix(docs, mixing.make_plan(mixing.weigh(docs), 8), "shard").collect()))
    want = mixed()
    no_broadcast()
    assert mixed() == want
