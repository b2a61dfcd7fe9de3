import pytest

from tallyboard.operators import quality

from .conftest import rows

SCHEMA = "Player string, Tm string"


def test_key_set_summary(make):
    a, b = make([("x",), ("y",)], "Player string"), make([("y",), ("x",), ("x",)], "Player string")
    assert tuple(quality.key_set_summary([a, b], ["Player"]).first()) == (2, True)
    c = make([("x",), (None,)], "Player string")
    assert tuple(quality.key_set_summary([a, b, c], ["Player"]).first()) == (3, False)
    assert rows(quality.key_presence([a, b, c], ["Player"])) == sorted([("x", 7), ("y", 3), (None, 4)], key=repr)


def test_check_stats_passes_and_names_the_fault(make):
    good = [("x", "A"), ("x", "TOT"), ("y", None)]
    a = make(good, SCHEMA)
    quality.check_stats([a, a, a])
    with pytest.raises(quality.QualityError, match="1 players are not in every table"):
        quality.check_stats([a, a, make(good[:2], SCHEMA)])
    with pytest.raises(quality.QualityError, match="table 2 has duplicates"):
        quality.check_stats([a, make(good + [("y", None)], SCHEMA), a])


def test_check_stats_per_season(make):
    a = make([("2000", "x", "A"), ("2001", "y", "A")], "season_year string, Player string, Tm string")
    b = make([("2001", "x", "A"), ("2000", "y", "A")], "season_year string, Player string, Tm string")
    quality.check_stats([a, a, a], ["season_year"])
    quality.check_stats([a, b, a])
    with pytest.raises(quality.QualityError):
        quality.check_stats([a, b, a], ["season_year"])


def test_duplicates_compare_nulls_equal(make):
    df = make([("x", None), ("x", None), ("y", "A")], SCHEMA)
    assert rows(quality.duplicate_keys(df, ["Player", "Tm"])) == [("x", None, 2)]
    with pytest.raises(quality.QualityError, match="table has duplicates"):
        quality.assert_unique(df, ["Player", "Tm"])
    quality.assert_unique(df.distinct(), ["Player", "Tm"])


def _awards(make):
    return make([("x", "2006-07"), ("x", "2006-07"), ("q", "2006-07"), ("y", "2007-08")],
                "Player string, award_season string")


def test_name_match_by_player_and_by_season(make):
    stats = make([("x", "2006-07"), ("y", "2006-07"), ("y", "2006-07")], "Player string, season string")
    assert rows(quality.name_match(_awards(make), stats)) == [("2006-07", 2, 1), ("2007-08", 1, 0)]
    strict = quality.name_match(_awards(make), stats, ["Player", "award_season"], ["Player", "season"])
    assert rows(strict) == [("2006-07", 2, 1), ("2007-08", 1, 1)]


def test_names_match_gate(make):
    stats = make([("y", "2006-07")], "Player string, season string")
    assert not quality.names_match(_awards(make), stats, ["2006-07", "2007-08"])
    assert quality.names_match(_awards(make), stats, ["2007-08"])
    assert not quality.names_match(_awards(make), stats, ["2007-08"], strict=True)
    assert quality.names_match(_awards(make), stats, ["1999-00"])  # nothing listed, nothing missing


def test_missing_players(make):
    stats = make([("x", "2006-07"), ("y", "2006-07")], "Player string, season string")
    assert rows(quality.missing_players(_awards(make), stats)) == [("q", "2006-07"), ("y", "2007-08")]


def test_value_counts(make):
    df = make([(1, "b"), (1, "a"), (1, "b"), (1, "c"), (2, "c")], "g int, v string")
    assert rows(quality.value_counts(df, ["g"], "v")) == [(1, "a", 1, 2), (1, "b", 2, 1), (1, "c", 1, 3), (2, "c", 1, 1)]


def test_name_match_moves_each_key_once(make, plan):
    awards = make([("x", "2006-07"), ("x", "2007-08"), (None, "2006-07"), ("y", None)], "Player string, award_season string")
    stats = make([("x",), ("x",), (None,)], "Player string")
    got = quality.name_match(awards, stats)
    assert plan(got, "simple").count("Exchange hashpartitioning") == 2
    assert rows(got) == sorted([("2006-07", 2, 0), ("2007-08", 1, 0), (None, 1, 1)], key=repr)
