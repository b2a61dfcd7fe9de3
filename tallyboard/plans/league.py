"""League-shaped raw tables derived from a star schema.

Suppliers stand for players, ship years for seasons, line items for games; a
supplier plays for up to three teams per season, one per return flag. Gives the
jobs raw player stats, standings, award pages and player attributes that grow
with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard import schemas as S
from tallyboard.functions import np_round
from tallyboard.operators.ranking import top_n
from tallyboard.session import scratch_path, scratch_table
from tallyboard.sinks import land

TEAMS = 25
VOTES = 15  # players on a page
POOL = 64  # players who stand for election together; there are more pools as there are more players
TEAM_NAMES = list(S.TEAM_CODES)[:TEAMS]
CODES = list(S.TEAM_CODES.values())[:TEAMS]


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return item.select(
        F.year("l_shipdate").alias("season_year"), F.col("l_suppkey").alias("player"),
        ((F.col("l_suppkey") + F.ascii("l_returnflag")) % TEAMS).alias("team"),
        F.col("l_quantity").cast("bigint").alias("pts"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("trb"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("ast"),
        (F.col("l_linenumber") * 8).cast("bigint").alias("mp"),
        (F.col("l_linenumber") <= 3).cast("bigint").alias("gs"),
        (F.col("l_linestatus") == "F").cast("bigint").alias("won"))


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per season, player and team, plus a TOT row for players with several teams."""
    sums = ["G", "GS", "MP", "PTS", "TRB", "AST"]
    per_team = games(spark, sf_dir).groupBy("season_year", "player", "team").agg(
        F.count(F.lit(1)).alias("G"), F.sum("gs").alias("GS"), F.sum("mp").alias("MP"),
        F.sum("pts").alias("PTS"), F.sum("trb").alias("TRB"), F.sum("ast").alias("AST"))
    # Totals add up the team rows, at most one per team, not the games again.
    totals = per_team.groupBy("season_year", "player").agg(
        F.count(F.lit(1)).alias("teams"), *[F.sum(c).alias(c) for c in sums]).where("teams > 1")
    rows = per_team.withColumn("Tm", _pick(CODES, F.col("team"))).drop("team").unionByName(
        totals.withColumn("Tm", F.lit(S.TOTAL_ROW)).drop("teams"))
    return rows.select(
        "season_year", F.col("player").alias("player_no"),
        F.concat(F.lit("Player "), F.col("player").cast("string"),
                 F.when(F.col("player") % 10 == 0, F.lit("*")).otherwise(F.lit(""))).alias("Player"),
        "Tm", _pick(["PG", "SG", "SF", "PF", "C"], F.col("player") % 5).alias("Pos"),
        (19 + F.col("player") % 20).alias("Age"), "G", "GS", "MP", "PTS", "TRB", "AST")


def raw_stats(rows: DataFrame, info: str) -> DataFrame:
    """Raw columns of one stats table, before any cleaning."""
    who = ["season_year", "Player", "Tm", "Pos", "Age", F.col("season_year").cast("string").alias("Season"), "G"]
    shots = (F.col("PTS") + 2 * F.col("AST")).alias("FGA")
    shot = (F.col("PTS") / (F.col("PTS") + F.col("MP"))).alias("FG%")
    if info == "totals":
        return rows.select(*who, "GS", "MP", "PTS", "TRB", "AST", shots, shot)
    if info == "per_game":
        per = {c: np_round(F.col(s) / F.col("G"), 1) for c, s in
               [("MP", "MP"), ("PTS", "PTS"), ("TRB", "TRB"), ("AST", "AST"), ("FGA", "FGA")]}
        return rows.withColumn("FGA", shots).select(*who, "GS", *[v.alias(c) for c, v in per.items()], shot)
    return rows.select(
        *who, "MP", np_round((F.col("PTS") + F.col("TRB") + F.col("AST")) / F.col("G") * 0.6, 1).alias("PER"),
        np_round(F.col("PTS") / 100, 1).alias("OWS"), np_round(F.col("TRB") / 50, 1).alias("DWS"),
        np_round(F.col("PTS") / 100 + F.col("TRB") / 50, 1).alias("WS"),
        (F.col("PTS") / F.col("MP") / 48).alias("WS/48"), np_round(F.col("AST") / 40, 1).alias("VORP"))


def raw_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings per season with marked team names and division header rows."""
    teams = games(spark, sf_dir).groupBy("season_year", "team").agg(
        F.sum("won").alias("won"), F.count(F.lit(1)).alias("played"))
    wins = F.floor(F.col("won") * 40 / F.col("played")).cast("bigint")
    rows = teams.select(
        "season_year", F.concat(_pick(TEAM_NAMES, F.col("team")), F.when(
            F.col("team") % 2 == 0, F.lit("*")).otherwise(F.lit(""))).alias("Tm"),
        wins.alias("W"), (41 - wins).alias("L"), (wins / 41).alias("W/L%"),
        (1 + F.col("team") % 18).cast("bigint").alias("Seed"))
    headers = teams.select("season_year").distinct().select(
        "season_year", F.explode(F.array(*[F.lit(d) for d in S.DIVISIONS])).alias("Tm"))
    return rows.unionByName(headers, allowMissingColumns=True)


def award_pages(rows: DataFrame) -> DataFrame:
    """One vote page per season and pool: the players with most points, some of them tied in rank."""
    pool = F.floor(F.col("player_no") / POOL).alias("pool")
    voted = top_n(rows.where(F.col("Tm") != S.TOTAL_ROW).groupBy("season_year", pool, "player_no").agg(
        F.min("Player").alias("Player"), F.max("PTS").alias("PTS")),
        ["season_year", "pool"], [F.col("PTS").desc(), F.col("player_no")], VOTES)
    rank = F.concat(F.col("pos").cast("string"), F.when(F.col("pos") > 9, F.lit("T")).otherwise(F.lit("")))
    share = np_round(F.col("PTS") / 1000, 3).cast("string")
    line = F.concat(F.lit("<tr><td>"), rank, F.lit("</td><td><a href='#'>"),
                    F.translate("Player", "*", ""), F.lit("</a></td><td>"), share, F.lit("</td></tr>"))
    head = ("<html><body><!-- <table><tr><td>old</td></tr></table> --><table><thead>"
            "<tr><th></th><th colspan='2'>Voting</th></tr>"
            "<tr><th>Rank</th><th>Player</th><th>Share</th></tr></thead><tbody>")
    # At most VOTES rows meet on a page.
    pages = voted.groupBy("season_year", "pool").agg(
        F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines"))
    return pages.select(
        F.concat(F.lit("https://example.org/pool/"), F.col("pool").cast("string"), F.lit("/awards/awards_"),
                 F.col("season_year").cast("string"), F.lit(".html")).alias("url"),
        F.concat(F.lit(head), F.array_join(F.transform("lines", lambda x: x["line"]), ""),
                 F.lit("</tbody></table><table><tr><td>99</td></tr></table></body></html>")).alias("html"))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player attributes the scoring job needs beside the stats."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return s.select(F.concat(F.lit("Player "), F.col("s_suppkey").cast("string")).alias("PLAYER"),
                    (180 + F.col("s_nationkey") * 1.27).alias("HEIGHT"),
                    (F.col("s_suppkey") % 15).alias("EXPERIENCE"), (F.col("s_suppkey") % 2).alias("COLLEGE"),
                    (F.col("s_nationkey") % 2).cast("bigint").alias("NATIONALITY_US"))


def land_raw(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Land all raw tables by season; returns their folder and the player seasons."""
    base = scratch_path(spark, "raw")
    rows = scratch_table(player_seasons(spark, sf_dir), "player_seasons")
    for info in S.INFOS:
        land(raw_stats(rows, info), f"{base}/stats/info={info}", ["season_year"])
    land(raw_standings(spark, sf_dir), f"{base}/standings", ["season_year"])
    return base, rows
