from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyboard import schemas as S
from tallyboard.operators import clean

from .conftest import rows


def test_clean_player_stats_per_info(make):
    schema = "Player string, Tm string, Pos string, Age int, Season string, G int, GS int, MP int, PTS int"
    df = make([("Ann Example*", "AAA", "C", 20, "2023", 10, 9, 300, 200)], schema)
    assert clean.clean_player_stats(df, "totals").columns == ["Player", "Tm", "GS_totals", "PTS_totals"]
    assert clean.clean_player_stats(df, "per_game").columns == ["Player", "Tm", "MP_per_game", "PTS_per_game"]
    advanced = clean.clean_player_stats(df, "advanced")
    assert advanced.columns == ["Player", "Tm", "Pos", "Age", "G_advanced", "GS_advanced", "MP_advanced", "PTS_advanced"]
    assert advanced.first()["Player"] == "Ann Example"


def test_dropping_an_absent_column_raises(make):
    with pytest.raises(KeyError):
        clean.clean_player_stats(make([("a", "b")], "Player string, Tm string"), "totals")


def test_clean_standings(make):
    df = make([("Utah Jazz*", 50, 0.610, 3), ("Pacific Division", None, None, None),
               ("Unknown Club", 30, 0.366, 12), (None, 1, 0.5, 15)],
              "Tm string, W int, `W/L%` double, Seed int")
    got = clean.clean_standings(df)
    assert got.columns == ["Tm", "W_team", "W/L%_team", "Seed"]
    assert rows(got) == sorted([("UTA", 50, 0.610, 3), ("Unknown Club", 30, 0.366, 12), (None, 1, 0.5, 15)], key=repr)


def test_all_team_names_map_to_distinct_codes():
    assert len(S.TEAM_CODES) == len(set(S.TEAM_CODES.values())) == 34
    assert all(len(c) == 3 for c in S.TEAM_CODES.values())


def test_total_rows_go_and_null_teams_stay(make):
    df = make([("a", "TOT"), ("a", "AAA"), ("b", None)], "Player string, Tm string")
    assert rows(clean.drop_total_rows(df)) == [("a", "AAA"), ("b", None)]


def test_stamps(make):
    at = datetime(2024, 1, 31, 10, 0, 5)
    df = clean.add_season(clean.add_snapshot_date(make([(1,)], "x int"), at), "2024")
    assert dict(df.dtypes)["snapshot_date"] == "timestamp_ntz"
    assert tuple(df.first()) == (1, at, "2023-24")


def test_enforce_types_fills_then_casts(make):
    df = make([(None, None, None, None, "x"), (float("nan"), "p", datetime(2024, 1, 1), 3.9, None)],
              "Age double, Pos string, snapshot_date timestamp_ntz, G_advanced double, other string")
    got = clean.enforce_types(df, S.COLUMN_TYPES)
    assert dict(got.dtypes) == {"Age": "bigint", "Pos": "string", "snapshot_date": "timestamp_ntz",
                                "G_advanced": "bigint", "other": "string"}
    assert [tuple(r) for r in got.collect()] == [
        (0, "0", datetime(1970, 1, 1), 0, "x"), (0, "p", datetime(2024, 1, 1), 3, None)]


def test_enforce_types_with_fill_all_and_cast_only(make):
    df = make([(None, None, None)], "Seed double, other string, MP_advanced int")
    declared = clean.enforce_types(df, S.COLUMN_TYPES)
    assert tuple(declared.first()) == (None, None, None)
    assert dict(declared.dtypes)["Seed"] == "bigint"
    assert tuple(clean.enforce_types(df, S.COLUMN_TYPES, fill="all").first()) == (0, "0", 0.0)


def test_enforce_types_raises_on_bad_text(make):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.enforce_types(make([("3.0",)], "Age string"), S.COLUMN_TYPES).collect()


def test_fill_share(make):
    df = make([("a", None, None, None), ("b", 0.5, "1", "2006-07")],
              "Player string, Share double, Rank string, award_season string")
    assert rows(clean.fill_share(df)) == [("a", 0.0), ("b", 0.5)]


def test_to_number_raises_on_bad_text(make):
    assert clean.to_number(make([("18.5",)], "PER_ADVANCED string"), "PER_ADVANCED").first()[0] == 18.5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.to_number(make([("x",)], "PER_ADVANCED string"), "PER_ADVANCED").collect()


def test_observed_counts_without_an_extra_pass(make):
    df, watch = clean.observed(make([(1, None), (2, 0.5)], "a int, Share double"), "seen", ["Share"])
    df.collect()
    assert watch.get == {"rows": 2, "Share": 1}


GOOD = {"PTS_PERGAME": 20.0, "MP_PERGAME": 35.0, "SEED": 1.0, "AST_PERGAME": 5.0, "TRB_PERGAME": 5.0,
        "FG%": 0.5, "FGA_PERGAME": 15.0, "PER_ADVANCED": 25.0}


def test_candidate_bounds(spark):
    """Each bound met exactly, missing and NaN: only SEED = 16 passes."""
    table = [{"name": "good", **GOOD}]
    for column, bound in {**S.CANDIDATE_ABOVE, **S.CANDIDATE_AT_MOST}.items():
        for label, value in (("equal", float(bound)), ("null", None), ("nan", float("nan"))):
            table.append({"name": f"{column} {label}", **GOOD, column: value})
    schema = "name string, " + ", ".join(f"`{c}` double" for c in GOOD)
    df = spark.createDataFrame([tuple(r.values()) for r in table], schema)
    assert sorted(r.name for r in clean.candidates(df).collect()) == ["SEED equal", "good"]


def test_project_season_worked_row(make):
    df = make([(50, 52, 1401.0, 3.25)], "G int, G_TEAM int, PTS_TOTAL double, VORP_ADVANCED double")
    got = clean.project_season(df, advanced=["VORP_ADVANCED"], whole=["G"]).first()
    assert (got["G_LEFT"], got["MULT_G"], got["PTS_TOTAL"], got["VORP_ADVANCED"]) == (30, 1.6, 2242, 5.2)


def test_project_season_raises_without_games(make):
    df = make([(0, 52, 1401.0)], "G int, G_TEAM int, PTS_TOTAL double")
    with pytest.raises(Exception, match="no whole number in PTS_TOTAL"):
        clean.project_season(df, advanced=[], whole=[]).collect()


def test_report_columns(make):
    df = make([(1, "a", 201.25, 0.4567)], "`Predicted MVP Rank` int, PLAYER string, HEIGHT double, `FG%` double")
    layout = {k: S.REPORT_COLUMNS[k] for k in ("Player", "Height (cm)", "FG%")}
    got = clean.report_columns(df, layout)
    assert got.columns == ["Predicted MVP Rank", "Player", "Height (cm)", "FG%"]
    assert tuple(got.first()) == (1, "a", 201.2, 45.67)


def test_scoring_names(make):
    df = make([("a", "AAA", 10, 8, 30, 20, 0.6, 500, 20.0, 19.5)],
              "Player string, Tm string, G_advanced int, GS_totals int, W_team int, L_team int, `W/L%_team` double, "
              "PTS_totals int, PTS_per_game double, PER_advanced double")
    got = clean.scoring_names(df)
    assert got.columns == ["PLAYER", "TEAM", "G", "GS", "W_team", "L_team", "PCT", "PTS_TOTAL", "PTS_PERGAME",
                           "PER_ADVANCED", "G_TEAM"]
    assert got.first()["G_TEAM"] == 50
    assert got.select(F.col("PCT")).first()[0] == 0.6
