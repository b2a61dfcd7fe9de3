import random

import pytest
from pyspark.sql import Window, functions as F

from tallyboard import schemas as S
from tallyboard.operators import ranking

from .conftest import rows

LISTS = {"SVM": "ABCDE", "Random Forest": "ACBED", "AdaBoost": "BADCE", "Gradient Boosting": "ABDCE", "LGBM": "CBADE"}
BALLOT = "mo int, model string, player string, pos int, share double"


def golden():
    return [(j, m, p, i + 1, round(0.9 - 0.1 * i - 0.01 * j, 3))
            for j, (m, players) in enumerate(LISTS.items()) for i, p in enumerate(players)]


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("group_rows", [10, 10_000])
def test_rank_all_equals_a_window(spark, many_partitions, group_rows):
    """One group holds a third of the rows and spans partitions; one group is null."""
    df = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('g', id % 40) END AS g",
        "CAST(hash(id) % 50 AS DOUBLE) AS v", "id")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranking.rank_all(df, ["g"], order, group_rows=group_rows)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.columns == ["g", "v", "id", "pos"]
    assert rows(got) == rows(want)
    one = ranking.rank_all(df, [], order, group_rows=group_rows).select("pos")
    assert rows(one) == sorted([(i,) for i in range(1, 6001)], key=repr)


def test_large_groups_are_not_windowed(spark, plan):
    df = spark.range(100).selectExpr("id % 5 AS g", "id")
    assert "row_number" in plan(ranking.rank_all(df, ["g"], [F.col("id").asc()], group_rows=20))
    assert "row_number" not in plan(ranking.rank_all(df, ["g"], [F.col("id").asc()], group_rows=19))


def test_rank_all_of_nothing(make):
    assert ranking.rank_all(make([], "g int, v int"), ["g"], [F.col("v").asc()]).count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_top_n(spark, by):
    df = spark.range(100).selectExpr("id % 5 AS g", "id")
    got = ranking.top_n(df, by, [F.col("id").desc()], 2)
    want = [(4, 99, 1), (3, 98, 2)] if not by else [(g, 95 + g - 5 * k, k + 1) for g in range(5) for k in range(2)]
    assert rows(got) == sorted(want, key=repr)


def test_top_n_prunes_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 5 AS g", "id")
    text = plan(ranking.top_n(df, ["g"], [F.col("id").desc()], 2), "simple")
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(ranking.top_n(df, [], [F.col("id").desc()], 2))


def test_rank_models_breaks_ties_by_player(make):
    df = make([("m", "b", 0.5), ("m", "a", 0.5), ("m", "c", None), ("n", "a", 0.1)], "model string, player string, share double")
    assert rows(ranking.rank_models(df).select("model", "player", "pos")) == [
        ("m", "a", 1), ("m", "b", 2), ("m", "c", 3), ("n", "a", 1)]


def test_wide_ranks_and_results(make):
    df = make([("SVM", "a", 0.12345), ("SVM", "b", 0.5), ("LGBM", "a", 0.9)], "model string, player string, share double")
    wide = ranking.wide_ranks(ranking.top_models(df, 2), ["SVM", "LGBM"])
    assert wide.columns == ["pos", "MVP RANK SVM", "MVP SHARE SVM", "MVP RANK LGBM", "MVP SHARE LGBM"]
    assert rows(wide) == [(1, "b", 0.5, "a", 0.9), (2, "a", 0.123, None, None)]
    results = ranking.wide_results(ranking.rank_models(df), ["SVM", "LGBM"])
    assert rows(results) == [("a", 0.12345, 2, 0.9, 1)]  # b has no LGBM score


def test_consensus_golden(make):
    got = ranking.consensus(make(golden(), BALLOT), n=5)
    assert [tuple(r) for r in got.orderBy("final_rank").collect()] == [(i + 1, p) for i, p in enumerate("ABCDE")]


def test_consensus_keeps_snapshots_apart(make):
    swapped = [(mo, m, {"A": "B", "B": "A"}.get(p, p), pos, s) for mo, m, p, pos, s in golden()]
    df = make([(1, *r) for r in golden()] + [(2, *r) for r in swapped], "day int, " + BALLOT)
    got = ranking.consensus(df, ["day"], n=5).groupBy("day").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("final_rank", "player"))), lambda x: x["player"]), ""))
    assert rows(got) == [(1, "ABCDE"), (2, "BACDE")]


def test_consensus_shuffles_once_per_run_column(spark, make, plan):
    df = make([(1, *r) for r in golden()], "day int, " + BALLOT)
    assert plan(ranking.consensus(df, ["day"]), "simple").count("Exchange") == 1


def test_consensus_special_cases(make):
    # Everyone named at position 2 is chosen at position 1 already.
    taken = [(0, "SVM", "a", 1, 0.9), (0, "SVM", "a", 2, 0.8)]
    assert rows(ranking.consensus(make(taken, BALLOT))) == [(1, "a"), (2, None)]
    # The tie-break models name only a chosen player at position 2: share sums decide.
    spent = [(j, m, "a", 1, 0.9) for j, m in enumerate(S.MODELS)]
    spent += [(0, "SVM", "a", 2, 0.5), (3, "Gradient Boosting", "a", 2, 0.5), (4, "LGBM", "a", 2, 0.5),
              (1, "Random Forest", "b", 2, 0.3), (2, "AdaBoost", "c", 2, 0.4)]
    assert rows(ranking.consensus(make(spent, BALLOT))) == [(1, "a"), (2, "c")]
    # Equal share sums and votes: the earlier model's player.
    equal = [(2, "AdaBoost", "x", 1, 0.4), (1, "Random Forest", "y", 1, 0.4)]
    assert rows(ranking.consensus(make(equal, BALLOT))) == [(1, "y")]


def by_hand(ballot, n):
    """Position by position, the rules one after the other."""
    shares, chosen = {}, []
    for _, _, player, pos, share in ballot:
        shares[player] = shares.get(player, 0) + round(share * 1000)
    for at in range(1, n + 1):
        here = [(mo, m, p) for mo, m, p, pos, _ in ballot if pos == at and p not in chosen]
        everyone = {p for _, _, p in here}
        all_votes = {p: sum(q == p for _, _, q in here) for p in everyone}
        few_votes = {p: sum(q == p and m in S.TIE_BREAK_MODELS for _, m, q in here) for p in everyone}
        most = [p for p in everyone if all_votes[p] >= 3] or [p for p in everyone if few_votes[p] >= 2]
        if not most:
            first_seen = {p: min(mo for mo, _, q in here if q == p) for p in everyone}
            most = sorted(everyone, key=lambda p: (-shares[p], -all_votes[p], first_seen[p]))
        chosen.append(most[0] if most else None)
    return chosen


def test_consensus_equals_the_rules_on_random_ballots(make):
    rng, ballots = random.Random(5), {}
    for b in range(400):
        pool = "ABCDEFGH"[:rng.randint(4, 8)]
        ballots[b] = [(j, m, p, i + 1, round(rng.random(), 3))
                      for j, m in enumerate(S.MODELS) for i, p in enumerate(rng.sample(pool, 4))]
    df = make([(b, *r) for b, rs in ballots.items() for r in rs], "b int, " + BALLOT)
    got = {}
    for r in ranking.consensus(df, ["b"], n=4).collect():
        got.setdefault(r.b, {})[r.final_rank] = r.player
    for b, rs in ballots.items():
        assert [got[b][i + 1] for i in range(4)] == by_hand(rs, 4), rs


def test_rank_history(make):
    df = make([("2024-01-01", 2, "b"), ("2024-01-01", 1, "a"), ("2024-01-02", 1, "c")], "run string, pos int, player string")
    got = ranking.rank_history(df, "run", [F.col("pos")], "player")
    assert got.columns == ["Rank", "Predicted MVP Rank", "Date"]
    assert rows(got) == [(1, "a", "2024-01-01"), (1, "c", "2024-01-02"), (2, "b", "2024-01-01")]


def test_one_row_per_player(make):
    df = make([("a", "X", 10), ("a", "Y", 20), ("a", "Z", 20), ("b", "X", 1)], "p string, t string, g int")
    got = ranking.one_row_per_player(df, ["p"], [F.col("g").desc(), F.col("t").asc()])
    assert rows(got) == [("a", "Y", 20), ("b", "X", 1)]


def test_missing_shares_come_last_and_add_nothing(make):
    df = make([(0, "SVM", "a", None), (0, "SVM", "b", 0.1), (1, "Random Forest", "a", None), (1, "Random Forest", "c", 0.2)],
              "mo int, model string, player string, share double")
    top = ranking.top_models(df, 2)
    assert rows(top.select("model", "player", "pos")) == [
        ("Random Forest", "a", 2), ("Random Forest", "c", 1), ("SVM", "a", 2), ("SVM", "b", 1)]
    assert rows(ranking.consensus(top)) == [(1, "c"), (2, "a")]
