"""The jobs on a small hand-made league; expected values are worked out by hand."""

import logging
from datetime import datetime

import pytest

from tallyboard import schemas as S
from tallyboard.operators import quality, scoring
from tallyboard.plans import jobs
from tallyboard.session import scratch_path
from tallyboard.sinks import land
from tallyboard.sources import read_table

from .conftest import rows

WHO = "season_year int, Player string, Tm string, Pos string, Age int, Season string, G int, "
TOTALS = WHO + "GS int, MP int, PTS int, `FG%` double"
PER_GAME = WHO + "GS int, MP double, PTS double"
ADVANCED = WHO + "MP int, PER double"
STANDINGS = "season_year int, Tm string, W int, L int, `W/L%` double, Seed int"

#        player          team   games points
PLAYED = [("Ann Example*", "UTA", 50, 1000), ("Bob Sample", "TOT", 60, 600), ("Bob Sample", "UTA", 20, 100),
          ("Bob Sample", "BOS", 40, 500), ("Cy None", "XYZ", 10, 0)]


def land_league(spark, base, played=PLAYED, years=(2007, 2008), advanced=None):
    def table(info, schema, line, source):
        df = spark.createDataFrame([(y, p, t, "C", 25, str(y), g, *line(g, pts)) for y in years for p, t, g, pts in source], schema)
        land(df, f"{base}/stats/info={info}", ["season_year"])
    table("totals", TOTALS, lambda g, pts: (g, g * 30, pts, pts / 2000 or None), played)
    table("per_game", PER_GAME, lambda g, pts: (g, 30.0, pts / g), played)
    table("advanced", ADVANCED, lambda g, pts: (g * 30, 20.5), advanced or played)
    standings = [(y, *r) for y in years for r in [
        ("Utah Jazz*", 50, 32, 0.61, 3), ("Boston Celtics", 41, 41, 0.5, 8), ("Pacific Division", None, None, None, None)]]
    land(spark.createDataFrame(standings, STANDINGS), f"{base}/standings", ["season_year"])


@pytest.fixture(scope="module")
def raw(spark):
    base = scratch_path(spark, "raw")
    land_league(spark, base)
    return base


AT = datetime(2024, 1, 31, 10, 0, 0)


def test_current_snapshot(spark, raw):
    out = scratch_path(spark, "players")
    for at in (AT, datetime(2024, 2, 1, 10), AT):  # the first day is run again
        got = jobs.current_snapshot(spark, raw, out, "2008", at)
    assert read_table(spark, out).count() == 10 and got.count() == 5
    assert dict(got.dtypes)["snapshot_date"] == "timestamp_ntz" and dict(got.dtypes)["GS_totals"] == "bigint"
    assert "season_year" not in got.columns and "Season" not in got.columns
    assert rows(got.select("Player", "Tm", "G_advanced", "PTS_per_game", "FG%_totals", "W_team", "Seed", "season", "snapshot_date")) == sorted([
        ("Ann Example", "UTA", 50, 20.0, 0.5, 50, 3, "2007-08", AT),
        ("Bob Sample", "TOT", 60, 10.0, 0.3, 0, None, "2007-08", AT),
        ("Bob Sample", "UTA", 20, 5.0, 0.05, 50, 3, "2007-08", AT),
        ("Bob Sample", "BOS", 40, 12.5, 0.25, 41, 8, "2007-08", AT),
        ("Cy None", "XYZ", 10, 0.0, 0.0, 0, None, "2007-08", AT)], key=repr)


def test_a_player_missing_from_one_table_stops_the_job(spark):
    base = scratch_path(spark, "raw")
    land_league(spark, base, advanced=PLAYED[:4])
    with pytest.raises(quality.QualityError, match="not in every table"):
        jobs.current_snapshot(spark, base, scratch_path(spark, "x"), "2008", AT)


def test_a_repeated_row_stops_the_job(spark):
    base = scratch_path(spark, "raw")
    land_league(spark, base, advanced=PLAYED + PLAYED[:1])
    with pytest.raises(quality.QualityError, match="duplicates"):
        jobs.historical_seasons(spark, base, scratch_path(spark, "x"), ["2007", "2008"])


def award_page(year, *lines):
    body = "".join(f"<tr><td>{r}</td><td>{p}</td><td>{s}</td></tr>" for r, p, s in lines)
    return (f"https://example.org/awards/awards_{year}.html",
            f"<table><tr><th colspan=3>Voting</th></tr><tr><th>Rank</th><th>Player</th><th>Share</th></tr>{body}</table>")


def history(spark, raw, make, *pages):
    base = scratch_path(spark, "job")
    seasons = ["2007", "2008"]
    landed = jobs.historical_seasons(spark, raw, f"{base}/historical", seasons)
    votes = jobs.award_votes(make(list(pages), "url string, html string"), f"{base}/awards")
    return base, seasons, landed, votes


def test_history_awards_and_training_set(spark, raw, make, caplog):
    base, seasons, landed, votes = history(
        spark, raw, make, award_page(2007, ("1", "Bob Sample", 0.5), ("10T", "Ann Example", 0.25)), award_page(2008, ("1", "Ann Example", 0.75)))
    assert landed.count() == 10
    assert {r.season for r in landed.collect()} == {"2006-07", "2007-08"}
    assert rows(landed.where("Tm = 'TOT' AND season_year = 2007").select("Seed", "W_team", "W/L%_team")) == [(0, 0, 0.0)]
    assert rows(votes) == sorted([("1", "Bob Sample", 0.5, "2006-07"), ("10", "Ann Example", 0.25, "2006-07"),
                                  ("1", "Ann Example", 0.75, "2007-08")], key=repr)
    with caplog.at_level(logging.INFO):
        got = jobs.training_set(spark, f"{base}/historical", f"{base}/awards", f"{base}/processed", seasons, strict=True)
    assert "8 rows, 4 of them with a share" in caplog.text
    assert "Rank" not in got.columns and "award_season" not in got.columns
    assert rows(got.select("Player", "Tm", "season", "Share")) == sorted([
        ("Ann Example", "UTA", "2006-07", 0.25), ("Bob Sample", "UTA", "2006-07", 0.5), ("Bob Sample", "BOS", "2006-07", 0.5),
        ("Cy None", "XYZ", "2006-07", 0.0), ("Ann Example", "UTA", "2007-08", 0.75), ("Bob Sample", "UTA", "2007-08", 0.0),
        ("Bob Sample", "BOS", "2007-08", 0.0), ("Cy None", "XYZ", "2007-08", 0.0)], key=repr)


def test_an_unknown_award_player_stops_the_training_set(spark, raw, make):
    base, seasons, _, _ = history(spark, raw, make, award_page(2007, ("1", "Nobody", 0.5)))
    with pytest.raises(quality.QualityError, match="1 award votes .* such as Nobody 2006-07; .* listed in") as e:
        jobs.training_set(spark, f"{base}/historical", f"{base}/awards", f"{base}/processed", seasons)
    assert rows(read_table(spark, str(e.value).rsplit(" ", 1)[1])) == [("Nobody", "2006-07")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, f"{base}/processed")


CANDIDATE = {"PLAYER": "string", "TEAM": "string", "POS": "string", "AGE": "int", "G": "int", "GS": "int", "G_TEAM": "int",
             "SEED": "int", "HEIGHT": "double", "EXPERIENCE": "int", "COLLEGE": "int", "NATIONALITY_US": "int", "PCT": "double",
             "PTS_PERGAME": "double", "MP_PERGAME": "double", "AST_PERGAME": "double", "TRB_PERGAME": "double",
             "STL_PERGAME": "double", "BLK_PERGAME": "double", "FGA_PERGAME": "double", "FG%": "double", "3P%": "double",
             "FT%": "double", "PER_ADVANCED": "string", "WS/48_ADVANCED": "double", "OWS_ADVANCED": "double",
             "DWS_ADVANCED": "double", "WS_ADVANCED": "double", "VORP_ADVANCED": "double", "PTS_TOTAL": "int"}


def candidate(player, team="UTA", games=41, points=25.0, seed=3, vorp=3.25):
    return (player, team, "C", 25, games, games, 41, seed, 201.25, 4, 1, 0, 0.6104, points, 35.0, 5.0, 9.0, 1.0, 1.0, 15.0,
            0.45678, 0.3, 0.8, "25.5", 0.21234, 2.0, 1.0, 3.0, vorp, int(points * games))


def snapshot(spark, by_day):
    schema = "day string, " + ", ".join(f"`{c}` {t}" for c, t in CANDIDATE.items())
    return spark.createDataFrame([(d, *r) for d, rs in by_day.items() for r in rs], schema)


SCORERS = {m: scoring.expression_scorer(e) for m, e in zip(
    S.MODELS, ["PTS_PERGAME / 100", "PTS_PERGAME / 90", "VORP_ADVANCED", "PTS_PERGAME / 80", "PTS_TOTAL / 5000"])}


@pytest.mark.parametrize("by", [["day"], []])
def test_score_and_rank(spark, by):
    traded = [candidate("T", "TOT", 80, 30.0, None), candidate("T", "BOS", 40, 30.0, 8), candidate("T", "AAA", 40, 30.0, 9)]
    days = {"d1": [candidate("A", points=28.0), candidate("B", points=20.0, vorp=9.0), candidate("low", points=13.5), *traded]}
    if by:
        days["d2"] = [candidate("B", points=29.0), candidate("A", points=21.0)]
    out = scratch_path(spark, "scored")
    report = jobs.score_and_rank(snapshot(spark, days), SCORERS, out, by=by)
    assert report.columns == [*by, S.REPORT_RANK, *S.REPORT_COLUMNS]
    first = report.where("day = 'd1'") if by else report
    # T leads three models, then A; B leads only by VORP. The AAA row wins the tie on games.
    assert rows(first.select(S.REPORT_RANK, "Player", "Team", "Games", "VORP (Projected)", "Height (cm)", "FG%", "WS/48", "PCT Team")) == [
        (1, "T", "AAA", 40, 6.6, 201.2, 45.68, 0.212, 0.61), (2, "A", "UTA", 41, 6.5, 201.2, 45.68, 0.212, 0.61),
        (3, "B", "UTA", 41, 18.0, 201.2, 45.68, 0.212, 0.61)]
    wide = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/rank")
    assert {f"MVP RANK {m}" for m in S.MODELS} | {"MVP RANK FINAL", "pos"} <= set(wide.columns)
    assert wide.count() == (5 if by else 3)
    saved = spark.read.option("header", True).csv(f"{out}/report")
    assert saved.count() == report.count()
    if by:
        assert rows(report.where("day = 'd2'").select(S.REPORT_RANK, "Player")) == [(1, "B"), (2, "A")]


def test_score_and_rank_reports_skipped_models(spark):
    scorers = {**SCORERS, "LGBM": scoring.expression_scorer("gone")}
    out = scratch_path(spark, "scored")
    report = jobs.score_and_rank(snapshot(spark, {"d1": [candidate("A")]}), scorers, out, on_error="skip")
    assert rows(report.select(S.REPORT_RANK, "Player")) == [(1, "A")]
    assert "MVP RANK LGBM" not in spark.read.option("header", True).csv(f"{out}/rank").columns


def test_final_report_refuses_repeated_players(spark, make):
    final = make([(1, "A")], "final_rank int, PLAYER string")
    layout = {"Player": ("PLAYER", None, 1)}
    with pytest.raises(quality.QualityError, match="stats has duplicates"):
        jobs.final_report(final, make([("A",), ("A",)], "PLAYER string"), layout=layout)
    with pytest.raises(quality.QualityError, match="final ranks has duplicates"):
        jobs.final_report(final.union(final), make([("A",)], "PLAYER string"), layout=layout)


def test_final_report_keeps_empty_positions(make):
    final = make([(1, "A"), (2, None)], "final_rank int, PLAYER string")
    got = jobs.final_report(final, make([("A", 1.0)], "PLAYER string, HEIGHT double"), layout={"Player": ("PLAYER", None, 1)})
    assert rows(got) == [(1, "A"), (2, None)]


def test_ingest_stream_job(spark, raw):
    folder, out, check = (scratch_path(spark, n) for n in ("players", "table", "check"))
    day = jobs.current_snapshot(spark, raw, folder, "2008", AT).drop("snapshot_day")
    from tallyboard.streaming import append_batches
    for _ in range(2):
        jobs.ingest_stream(spark, f"{folder}/snapshot_day=2024_01_31", day.schema, check, append_batches(out))
    assert rows(read_table(spark, out).drop("batch_id")) == rows(day)


def test_ingest_batch_job(spark, raw, monkeypatch):
    sent = []
    monkeypatch.setattr(jobs, "append_jdbc", lambda df, *a: sent.append((df.count(), "snapshot_day" in df.columns, a)))
    folder = scratch_path(spark, "players")
    jobs.current_snapshot(spark, raw, folder, "2008", AT)
    jobs.ingest_batch(spark, folder, "2024_01_31", "jdbc:x", "public.stats")
    assert sent == [(5, False, ("jdbc:x", "public.stats", None))]


def test_season_table_joins_shuffle_each_table_once(spark, raw, plan):
    from tallyboard.operators import clean, joins
    from tallyboard.sources import read_player_stats
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [clean.clean_player_stats(read_player_stats(spark, raw, i, ["2007"]), i, ["season_year"]) for i in S.INFOS]
        text = plan(joins.merge_stats(tables, ["season_year", "Player", "Tm"]), "simple")
        assert text.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidate_bounds_reach_the_landed_scan(spark, raw, plan):
    from tallyboard.operators import clean
    folder = scratch_path(spark, "players")
    landed = jobs.current_snapshot(spark, raw, folder, "2008", AT)
    text = plan(clean.candidates(clean.scoring_names(landed), {"PTS_PERGAME": 13.5}, {"SEED": 16}).select("PLAYER"))
    assert "GreaterThan(PTS_per_game,13.5)" in text and "LessThanOrEqual(Seed,16)" in text
    assert "FG%" not in text.split("ReadSchema")[1]


def test_rank_evolution_grows_run_by_run(spark, make):
    from tallyboard.sinks import write_rank_csv
    path, out = scratch_path(spark, "ranks"), scratch_path(spark, "history")
    for day in ("31_01_2024", "01_02_2024"):
        wide = make([(2, "B", "x"), (1, "A", day)], "pos int, `MVP RANK FINAL` string, other string")
        write_rank_csv(wide, f"{path}/rank_{day}")
        for _ in range(2):
            got = jobs.rank_evolution(spark, path, out)
    assert got.columns == ["Rank", "Predicted MVP Rank", "Date"]
    assert rows(got.selectExpr("Rank", "`Predicted MVP Rank`", "date_format(Date, 'dd/MM/yyyy')")) == [
        (1, "A", "01/02/2024"), (1, "A", "31/01/2024"), (2, "B", "01/02/2024"), (2, "B", "31/01/2024")]


def test_scoring_snapshot_joins_attributes(make):
    landed = make([("A", "UTA", 10), ("B", "BOS", 5)], "Player string, Tm string, PTS_totals int")
    got = jobs.scoring_snapshot(landed, make([("A", 200.0)], "PLAYER string, HEIGHT double"))
    assert rows(got) == sorted([("A", "UTA", 10, 200.0), ("B", "BOS", 5, None)], key=repr)
