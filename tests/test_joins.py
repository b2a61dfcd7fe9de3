from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import joins

from .conftest import rows


def test_merge_stats_matches_null_keys(make):
    a = make([("x", "A", 1), ("y", None, 2)], "Player string, Tm string, p int")
    b = make([("x", "A", 3), ("y", None, 4), ("z", "B", 5)], "Player string, Tm string, q int")
    c = make([("x", "A", 6), ("y", None, 7)], "Player string, Tm string, r int")
    got = joins.merge_stats([a, b, c], ["Player", "Tm"])
    assert got.columns == ["Player", "Tm", "p", "q", "r"]
    assert rows(got) == [("x", "A", 1, 3, 6), ("y", None, 2, 4, 7)]


def test_standings_left_join_broadcasts_and_fans_out(make, plan):
    stats = make([("x", "A"), ("x", "TOT"), ("y", "B")], "Player string, Tm string")
    standings = make([("A", 1), ("B", 2), ("B", 3)], "Tm string, Seed int")
    got = joins.with_standings(stats, standings)
    assert rows(got) == sorted([("x", "A", 1), ("x", "TOT", None), ("y", "B", 2), ("y", "B", 3)], key=repr)
    assert "BroadcastHashJoin" in plan(got)


def test_a_large_side_is_not_broadcast(make, monkeypatch, spark, plan):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        standings = make([("A", 1), ("B", 2)], "Tm string, Seed int")
        got = joins.with_standings(make([("x", "A")], "Player string, Tm string"), standings)
        assert "BroadcastHashJoin" not in plan(got) and rows(got) == [("x", "A", 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_size_counts_text_and_nulls(make):
    assert joins.measured_size(make([("abc", 1), (None, 2)], "s string, n int")) == (2, 3 + 16 + 16 + 8 + 8)
    assert joins.measured_size(make([], "s string")) == (0, 0)


@pytest.mark.parametrize("landed", [True, False])
def test_award_join_repeats_for_traded_players(make, landed):
    stats = make([("x", "A", "2006-07"), ("x", "B", "2006-07"), ("x", "A", "2007-08")],
                 "Player string, Tm string, season string")
    awards = make([("1", "x", 0.5, "2006-07"), ("2", "q", 0.1, "2006-07")],
                  "Rank string, Player string, Share double, award_season string")
    got = joins.with_awards(stats, awards, landed)
    assert got.columns == ["Player", "Tm", "season", "Rank", "Share", "award_season"]
    assert rows(got.select("Player", "Tm", "season", "Share")) == sorted(
        [("x", "A", "2006-07", 0.5), ("x", "B", "2006-07", 0.5), ("x", "A", "2007-08", None)], key=repr)


def test_missing_keys_keep_repeats_and_match_nulls(make):
    left = make([("x", "1"), ("x", "1"), ("y", "1"), (None, "1"), ("z", None)], "p string, s string")
    right = make([("y", "1"), (None, "1"), ("x", "2")], "q string, t string")
    got = joins.missing_keys(left, right, ["p", "s"], ["q", "t"])
    assert rows(got) == sorted([("x", "1"), ("x", "1"), ("z", None)], key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_bound", [True, False])
def test_skew_join_equals_plain_join(spark, make, how, hot_bound, monkeypatch):
    """A third of the rows has one key, another third has a null key."""
    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 50) END AS k", "id AS v")
    right = make([("hot", 1), (None, 2)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, w int")
    if not hot_bound:  # the hot keys' right rows count as too many to broadcast
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    want = joins.key_join(left, right, ["k"], ["k"], how)
    got = joins.skew_join(left, right, ["k"], how=how, hot_rows=500)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_keys_are_found_and_few(spark):
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k")
    types = [left.schema["k"].dataType]
    assert len(joins.hot_key_hashes(left, ["k"], types, 500)) == 1
    assert joins.hot_key_hashes(left, ["k"], types) == []


def test_keys_of_different_types_meet_in_the_skew_path(spark, make):
    left = spark.range(100).selectExpr("CAST(id % 2 AS BIGINT) AS k")
    right = make([(0,)], "j int")
    assert joins.missing_keys(left, right, ["k"], ["j"], hot_rows=10).count() == 50


TYPED = {
    "string/int": ("IF(id % 4 = 0, NULL, lpad(CAST(id % 3 AS STRING), 2, '0')) AS k", [(1, 10), (None, 11), (7, 12)], "j int, w int"),
    "int/bigint": ("CAST(id % 3 AS INT) AS k", [(1, 10), (1 << 40, 11), (None, 12)], "j bigint, w int"),
    "int/double": ("CAST(id % 3 AS INT) AS k", [(1.0, 10), (-0.0, 11), (1.5, 12)], "j double, w int"),
    "date/timestamp": ("date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS k",
                       [(datetime(2024, 1, 2), 10), (datetime(2024, 1, 3, 1), 11)], "j timestamp, w int"),
}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("kinds", TYPED)
def test_hot_and_cold_paths_agree_on_keys_of_different_types(spark, make, kinds, how):
    key, right_rows, schema = TYPED[kinds]
    left, right = spark.range(300).selectExpr(key, "id AS v"), make(right_rows, schema)
    want = left.join(right, F.col("k").eqNullSafe(F.col("j")), how).drop("j")
    plain = joins.key_join(left, right, ["k"], ["j"], how)
    hot = joins.skew_join(left, right, ["k"], ["j"], how, hot_rows=10)
    assert rows(hot) == rows(plain) == rows(want)
    types = joins._key_types(left, right, ["k"], ["j"])
    assert joins.hot_key_hashes(left, ["k"], types, 10)


def test_grouped_sides_are_not_shuffled_again_without_nulls(spark, plan):
    base = spark.range(1000).selectExpr("id % 10 AS k", "id % 7 AS j")
    a, b = base.groupBy("k").count(), base.groupBy("k").sum("j")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.merge_stats([a, b], ["k"], nulls_match=False), "simple")
        assert text.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
