"""Registered queries on the star-schema tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyboard import schemas as S
from tallyboard.functions import np_round, rank_text
from tallyboard.operators import clean, joins, kernels, quality, ranking, scoring, trees
from tallyboard.operators.profile import StepProfile
from tallyboard.plans import jobs, league
from tallyboard.session import scratch_path, scratch_table, spread
from tallyboard.sinks import (append_batch, append_new, append_table, land, overwrite_partitions, read_batches, read_published,
                              write_report_csv, write_table)
from tallyboard.sources import award_rows, read_csv, read_player_stats, read_seasons, read_table, seasons_of, union_seasons
from tallyboard.streaming import (append_batches, append_named_objects, event_keys, ingest_new_files, land_noticed_objects, landed_objects,
                                  missing_objects, stream_rank_history)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# --- shaping -----------------------------------------------------------------

@register("SELECT s_suppkey, replace(s_name,'#','') AS s_name, s_acctbal AS s_acctbal_totals FROM supplier")
def strip_suffix_rename(spark, sf_dir):
    df = clean.drop_columns(table(spark, sf_dir, "supplier"), ["s_nationkey"])
    return clean.add_suffix(clean.strip_column(df, "s_name", "#"), "_totals", ["s_suppkey", "s_name"])


@register("SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'MAC' WHEN 'BUILDING' THEN 'BLD' "
          "ELSE c_mktsegment END AS tm FROM customer")
def code_lookup_passthrough(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("tm"))
    return clean.lookup_code(df, "tm", {"MACHINERY": "MAC", "BUILDING": "BLD"})


@register("WITH t AS (SELECT p_partkey, nullif(p_type,'STANDARD') AS tm FROM part) "
          "SELECT p_partkey, tm FROM t WHERE tm IS NULL OR tm NOT IN ('ECONOMY','PROMO','LARGE')")
def null_safe_exclusion(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_type", F.lit("STANDARD")).alias("tm"))
    return clean.drop_total_rows(clean.exclude_values(df, "tm", ["ECONOMY", "PROMO"]), "tm", "LARGE")


@register("SELECT o_orderkey, CAST(year(o_orderdate)-1 AS VARCHAR) || '-' || "
          "substr(CAST(year(o_orderdate) AS VARCHAR),3) AS season, "
          "TIMESTAMP '2024-01-31 10:00:00' AS snapshot_date FROM orders")
def season_label(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    df = clean.add_season(df, F.year("o_orderdate"))
    return clean.add_snapshot_date(df, datetime(2024, 1, 31, 10)).select("o_orderkey", "season", "snapshot_date")


@register("SELECT p_partkey, split_part(CAST(p_size AS VARCHAR) || "
          "CASE WHEN p_size%2=0 THEN 'T' ELSE '' END,'T',1) AS rank FROM part")
def rank_tie_strip(spark, sf_dir):
    tied = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "T").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", rank_text(tied).alias("rank"))


@register("SELECT p_partkey, coalesce(nullif(p_type,'ECONOMY'),'0') AS pos, "
          "CAST(trunc(coalesce(nullif(p_retailprice,900.0),0)) AS BIGINT) AS price_i, "
          "CAST(p_size AS DOUBLE) AS size_n FROM part")
def schema_enforce(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif("p_type", F.lit("ECONOMY")).alias("pos"),
        F.nullif("p_retailprice", F.lit(900.0)).alias("price_i"), F.col("p_size").cast("string").alias("size_n"))
    return clean.enforce_types(clean.to_number(df, "size_n"), {"pos": "string", "price_i": "bigint", "absent": "bigint"})


# --- joins -------------------------------------------------------------------

@register("""
WITH a AS (SELECT l_suppkey,l_linenumber,sum(l_quantity) AS qty_totals FROM lineitem WHERE l_returnflag='A' GROUP BY 1,2),
b AS (SELECT l_suppkey,l_linenumber,count(*) AS n_advanced FROM lineitem WHERE l_returnflag='N' GROUP BY 1,2),
c AS (SELECT l_suppkey,l_linenumber,max(l_quantity) AS mx_per_game FROM lineitem WHERE l_returnflag='R' GROUP BY 1,2)
SELECT a.l_suppkey,a.l_linenumber,qty_totals,n_advanced,mx_per_game
FROM a JOIN b USING(l_suppkey,l_linenumber) JOIN c USING(l_suppkey,l_linenumber)""")
def stats_nway_inner(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem")
    parts = [("A", F.sum("l_quantity").alias("qty_totals")), ("N", F.count(F.lit(1)).alias("n_advanced")),
             ("R", F.max("l_quantity").alias("mx_per_game"))]
    keys = ["l_suppkey", "l_linenumber"]
    return joins.merge_stats([item.where(F.col("l_returnflag") == flag).groupBy(*keys).agg(measure)
                              for flag, measure in parts], keys, nulls_match=False)


@register("SELECT c_custkey, n.n_name AS team FROM customer LEFT JOIN "
          "(SELECT * FROM nation WHERE n_regionkey<>0) n ON c_nationkey=n.n_nationkey")
def standings_left(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("Tm"))
    standings = table(spark, sf_dir, "nation").where("n_regionkey <> 0").select(
        F.col("n_nationkey").alias("Tm"), F.col("n_name").alias("team"))
    return joins.with_standings(customer, standings).select("c_custkey", "team")


@register("""
WITH award AS (SELECT o_custkey AS player, year(o_orderdate) AS yr, max(o_totalprice) AS share
  FROM orders WHERE o_orderpriority='1-URGENT' GROUP BY 1,2),
stats AS (SELECT o_custkey AS player, year(o_orderdate) AS season, count(*) AS n FROM orders GROUP BY 1,2)
SELECT s.player, s.season, s.n, coalesce(a.share,0) AS share, count(*) OVER () AS n_rows, count(a.share) OVER () AS n_shares
FROM stats s LEFT JOIN award a ON s.player=a.player AND s.season=a.yr""")
def award_left_fill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate").cast("bigint"))
    key = [F.col("o_custkey").alias("Player")]
    stats = orders.groupBy(*key, "season").agg(F.count(F.lit(1)).alias("n"))
    votes = orders.where("o_orderpriority = '1-URGENT'").groupBy(*key, F.col("season").alias("award_season")).agg(
        F.max("o_totalprice").alias("Share"), F.lit("1").alias("Rank"))
    labelled, counts = clean.observed(joins.with_awards(stats, votes, landed=False, nulls_match=False), "labelled", ["Share"])
    # The counts are there once the labelled rows have been written.
    filled = scratch_table(clean.fill_share(labelled).select(
        F.col("Player").alias("player"), "season", "n", F.col("Share").alias("share")), "labelled")
    return filled.withColumns({"n_rows": F.lit(counts.get["rows"]), "n_shares": F.lit(counts.get["Share"])})


@register("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS "
          "(SELECT 1 FROM lineitem l WHERE l.l_orderkey=o.o_orderkey)")
def missing_keys_anti(spark, sf_dir):
    return joins.missing_keys(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
                              table(spark, sf_dir, "lineitem"), ["o_orderkey"], ["l_orderkey"], nulls_match=False)


_TYPED_KEY = "CASE WHEN l_linenumber % 3 = 0 THEN '0007' WHEN l_linenumber = 1 THEN NULL ELSE lpad(CAST(l_suppkey AS VARCHAR(9)), 12, '0') END"


@register(f"WITH i AS (SELECT l_orderkey, l_linenumber, {_TYPED_KEY} AS supplier FROM lineitem) "
          "SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s_suppkey%2=0 AND s_suppkey=CAST(i.supplier AS BIGINT))")
def missing_keys_typed(spark, sf_dir):
    """Text keys against integer keys; one key and the null key own a third of the rows each, and are joined apart."""
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_TYPED_KEY).alias("supplier"))
    return joins.missing_keys(item, table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0"), ["supplier"], ["s_suppkey"], hot_rows=500)


# --- checks ------------------------------------------------------------------

@register("""
WITH k AS (SELECT l_suppkey AS k, max(CASE WHEN l_returnflag='A' THEN 1 ELSE 0 END) AS a,
  max(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END) AS b, max(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS c
  FROM lineitem GROUP BY 1)
SELECT count(*) AS n_keys, sum(CASE WHEN a+b+c<3 THEN 1 ELSE 0 END)=0 AS sets_equal FROM k""")
def key_set_equality(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem")
    return quality.key_set_summary([item.where(F.col("l_returnflag") == f) for f in "ANR"], ["l_suppkey"])


@register("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1,2 HAVING count(*)>1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("""
WITH a AS (SELECT DISTINCT year(o_orderdate) AS season, o_orderkey AS k FROM orders)
SELECT a.season, count(*) AS n_award, count(*) FILTER (WHERE l.l_orderkey IS NULL) AS n_unmatched
FROM a LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON a.k=l.l_orderkey GROUP BY 1""")
def award_name_match(spark, sf_dir):
    awards = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("season"), F.col("o_orderkey").alias("Player"))
    return quality.name_match(awards, table(spark, sf_dir, "lineitem"), ["Player"], ["l_orderkey"], "season")


@register("SELECT user_id, event_type, count(*) AS n, "
          "row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS ord FROM events GROUP BY 1,2")
def value_counts(spark, sf_dir):
    return quality.value_counts(table(spark, sf_dir, "events"), ["user_id"], "event_type")


# --- candidates and scores ---------------------------------------------------

@register("SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem "
          "WHERE l_quantity>30 AND l_extendedprice>1350 AND l_discount>0.03 AND l_tax<=0.06 AND l_linenumber<=4")
def candidate_filter(spark, sf_dir):
    kept = clean.candidates(table(spark, sf_dir, "lineitem"),
                            {"l_quantity": 30, "l_extendedprice": 1350, "l_discount": 0.03},
                            {"l_tax": 0.06, "l_linenumber": 4})
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@register("""
WITH t AS (SELECT o_custkey AS player, count(*) AS g,
  CAST(sum(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) AS BIGINT) AS g_team, max(o_totalprice) AS mx
  FROM orders GROUP BY 1)
SELECT player, 82-g_team AS g_left, (82-g_team)/g+1 AS mult_g,
  CAST(round_even(mx*((82-g_team)/g+1),0) AS BIGINT) AS pts_total,
  round_even(mx/1000*((82-g_team)/g+1),1) AS vorp_advanced FROM t""")
def pace_projection(spark, sf_dir):
    t = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("player")).agg(
        F.count(F.lit(1)).alias("G"), F.count_if(F.col("o_orderstatus") == "F").alias("G_TEAM"),
        F.max("o_totalprice").alias("PTS_TOTAL"))
    p = clean.project_season(t.withColumn("VORP_ADVANCED", F.col("PTS_TOTAL") / 1000),
                             advanced=["VORP_ADVANCED"], whole=["G"])
    return p.select("player", F.col("G_LEFT").alias("g_left"), F.col("MULT_G").alias("mult_g"),
                    F.col("PTS_TOTAL").alias("pts_total"), F.col("VORP_ADVANCED").alias("vorp_advanced"))


_FEAT = """feat AS (SELECT s.s_suppkey AS player, s.s_acctbal AS bal, sum(l.l_quantity) AS qty, count(*) AS n
  FROM supplier s JOIN lineitem l ON s.s_suppkey=l.l_suppkey GROUP BY 1,2)"""
_SCORED = _FEAT + """,
scored AS (SELECT 0 AS mo,'SVM' AS model,player,qty/1000 AS share FROM feat
  UNION ALL SELECT 1,'Random Forest',player,CAST(n AS DOUBLE) FROM feat
  UNION ALL SELECT 2,'AdaBoost',player,bal FROM feat
  UNION ALL SELECT 3,'Gradient Boosting',player,qty/n FROM feat
  UNION ALL SELECT 4,'LGBM',player,qty/1000+n/10 FROM feat),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY share DESC, player) AS pos FROM scored)"""
_SCORERS = {m: scoring.expression_scorer(e) for m, e in zip(
    S.MODELS, ["qty / 1000", "n", "bal", "qty / n", "qty / 1000 + n / 10"], strict=True)}


def _feat(spark, sf_dir):
    # Line items shrink to one row per supplier before they meet the suppliers.
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("player")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"))
    who = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("player"), F.col("s_acctbal").alias("bal"))
    return sums.join(who, "player")


def _scored(spark, sf_dir):
    return scoring.score_models(_feat(spark, sf_dir), _SCORERS, ["player"])[0]


@register(f"""WITH {_FEAT} SELECT player,
  round_even((qty-(SELECT avg(qty) FROM feat))/(SELECT stddev_pop(qty) FROM feat),6) AS z FROM feat""")
def standard_scale(spark, sf_dir):
    return scoring.standardize(_feat(spark, sf_dir), ["qty"]).select("player", np_round(F.col("qty"), 6).alias("z"))


@register(f"WITH {_SCORED} SELECT model, player, round_even(share,3) AS share, pos FROM ranked")
def multi_model_rank(spark, sf_dir):
    return ranking.rank_models(_scored(spark, sf_dir), players=_feat(spark, sf_dir)).select(
        "model", "player", np_round(F.col("share"), 3).alias("share"), "pos")


def _per_model(columns):
    """SQL that puts every model's value of each (name, expression) in a column of its own."""
    return ", ".join(f"max(CASE WHEN model='{m}' THEN {value} END) AS \"{name} {m}\"" for m in S.MODELS for name, value in columns)


@register(f"""WITH {_SCORED} SELECT player,
  {_per_model([("PREDICTED MVP SHARE", "round_even(share,3)"), ("MVP RANK", "pos")])} FROM ranked GROUP BY player""")
def multi_model_wide(spark, sf_dir):
    ranked = ranking.rank_models(_scored(spark, sf_dir), players=_feat(spark, sf_dir))
    return ranking.wide_results(ranked.withColumn("share", np_round(F.col("share"), 3)))


@register(f"""WITH {_SCORED} SELECT pos,
  {_per_model([("MVP RANK", "player"), ("MVP SHARE", "round_even(share,3)")])} FROM ranked WHERE pos<=10 GROUP BY pos""")
def topn_wide(spark, sf_dir):
    return ranking.wide_ranks(ranking.top_models(_scored(spark, sf_dir)))


@register(f"""WITH RECURSIVE {_SCORED},
top AS (SELECT mo,model,player,pos,round_even(share,3) AS share FROM ranked WHERE pos<=10),
tot AS (SELECT player, sum(CAST(share AS DECIMAL(18,3))) AS share_sum FROM top GROUP BY 1),
cand AS (SELECT pos, player, count(*) AS votes,
  count(*) FILTER (WHERE model IN ('SVM','Gradient Boosting','LGBM')) AS votes3, min(mo) AS seen FROM top GROUP BY 1,2),
pref AS (SELECT pos, list(player ORDER BY (votes>=3) DESC, (votes3>=2) DESC, share_sum DESC, votes DESC, seen) AS l
  FROM cand JOIN tot USING(player) GROUP BY pos),
step AS (SELECT 0::BIGINT AS pos, []::BIGINT[] AS chosen
  UNION ALL SELECT p.pos, list_append(s.chosen, list_filter(p.l, lambda x: NOT list_contains(s.chosen,x))[1])
  FROM step s JOIN pref p ON p.pos=s.pos+1)
SELECT pos AS final_rank, chosen[pos] AS player FROM step WHERE pos>0""")
def consensus_rank(spark, sf_dir):
    return ranking.consensus(ranking.top_models(_scored(spark, sf_dir)))


@register(f"""WITH {_FEAT}, r AS (SELECT player, row_number() OVER (ORDER BY qty DESC, player) AS rk FROM feat)
SELECT r.rk AS "Predicted MVP Rank", s.s_name AS "Player", round_even(s.s_acctbal*100,2) AS "Bal (x100)"
FROM r LEFT JOIN supplier s ON r.player=s.s_suppkey WHERE r.rk<=10""")
def final_rank_report(spark, sf_dir):
    best = ranking.top_n(_feat(spark, sf_dir), [], [F.col("qty").desc(), F.col("player").asc()], 10, "final_rank")
    final = best.select("final_rank", F.col("player").alias("PLAYER"))
    stats = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("PLAYER"), "s_name", "s_acctbal")
    return jobs.final_report(final, stats, layout={"Player": ("s_name", None, 1), "Bal (x100)": ("s_acctbal", 2, 100)}, validate="plan")


@register("SELECT CAST(ts AS DATE) AS d, user_id, row_number() OVER "
          "(PARTITION BY CAST(ts AS DATE) ORDER BY max(value) DESC, user_id) AS rk FROM events GROUP BY 1,2 QUALIFY rk<=10")
def rank_evolution(spark, sf_dir):
    best = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("d"), "user_id").agg(F.max("value").alias("v"))
    top = ranking.top_n(best, ["d"], [F.col("v").desc(), F.col("user_id").asc()], 10)
    path = scratch_path(spark, "ranks")
    write_report_csv(top.select(F.date_format("d", "dd_MM_yyyy").alias("run"), "pos", "user_id"), path, ["run"])
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("user_id", T.LongType())])
    history = jobs.rank_evolution(spark, path, f"{path}-history", player="user_id", schema=schema)
    return history.select(F.col("Date").alias("d"), F.col("Predicted MVP Rank").alias("user_id"), F.col("Rank").alias("rk"))


# --- sources and sinks -------------------------------------------------------

@register("SELECT o_orderkey, year(o_orderdate) AS season_year, "
          "CASE WHEN year(o_orderdate)>=1998 THEN o_orderpriority END AS pri "
          "FROM orders WHERE year(o_orderdate) IN (1996,1998,2000)")
def season_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("pri"), F.year("o_orderdate").alias("season_year"))
    base = scratch_path(spark, "seasons")
    # Older files lack a column, as tables that grew over the years do.
    old, new = orders.where("season_year < 1998").drop("pri"), orders.where("season_year >= 1998")
    overwrite_partitions(old, base, ["season_year"])
    overwrite_partitions(new, base, ["season_year"])
    late = read_seasons(spark, base, ["1998", "2000"], orders.schema)
    early = read_seasons(spark, base, ["1996"], orders.drop("pri").schema)
    return union_seasons([late, early]).withColumn("season_year", F.col("season_year").cast("bigint"))


@register("SELECT o_orderkey, CASE year(o_orderdate) WHEN 1996 THEN o_custkey % 1000 WHEN 1997 THEN o_custkey ELSE o_totalprice END::DOUBLE AS pts, "
          "CASE WHEN year(o_orderdate) <> 1996 THEN o_orderpriority END AS pri, CASE WHEN year(o_orderdate) = 1997 THEN o_custkey % 7 = 0 END AS star, "
          "year(o_orderdate) AS season_year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999")
def season_drift(spark, sf_dir):
    """Seasons that hold one column as int, bigint and double, and others not at all; two of them agree and are one read."""
    orders = table(spark, sf_dir, "orders").withColumn("season_year", F.year("o_orderdate"))
    base = scratch_path(spark, "drifting")

    def landed(year, *columns):
        overwrite_partitions(orders.where(year).select("o_orderkey", *columns, "season_year"), base, ["season_year"])
    landed(F.col("season_year") == 1996, (F.col("o_custkey") % 1000).cast("int").alias("pts"))
    landed(F.col("season_year") == 1997, F.col("o_custkey").cast("bigint").alias("pts"), F.col("o_orderpriority").alias("pri"),
           (F.col("o_custkey") % 7 == 0).alias("star"))
    landed(F.col("season_year") >= 1998, F.col("o_totalprice").alias("pts"), F.col("o_orderpriority").alias("pri"))
    return read_seasons(spark, base, range(1996, 2000)).withColumn("season_year", F.col("season_year").cast("bigint"))


@register("SELECT l_orderkey, l_linenumber, l_quantity, year(l_shipdate) AS season_year "
          "FROM lineitem WHERE l_returnflag='A' AND year(l_shipdate) IN (1997, 2000)")
def landed_partition_scan(spark, sf_dir):
    item = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("season_year"),
        F.element_at(F.create_map(*[F.lit(x) for x in ("A", "totals", "N", "advanced", "R", "per_game")]),
                     F.col("l_returnflag")).alias("info"))
    base = scratch_path(spark, "raw")
    land(item, f"{base}/stats", ["info", "season_year"])
    rows = read_player_stats(spark, base, "totals", ["1997", "2000"])
    return rows.withColumn("season_year", F.col("season_year").cast("bigint"))


@register("SELECT o_orderkey, CAST(o_custkey%20 AS VARCHAR) AS \"Rank\", o_orderpriority AS \"Player\", "
          "o_totalprice AS \"Share\", CAST(year(o_orderdate)-1 AS VARCHAR) || '-' || "
          "substr(CAST(year(o_orderdate) AS VARCHAR),3) AS award_season FROM orders")
def html_table_extract(spark, sf_dir):
    def tag(name, *parts):
        return F.concat(F.lit(f"<{name}>"), *[p if not isinstance(p, str) else F.lit(p) for p in parts], F.lit(f"</{name}>"))
    rank = F.concat((F.col("o_custkey") % 20).cast("string"), F.when(F.col("o_custkey") % 2 == 0, "T").otherwise(""))
    html = F.concat(
        F.lit("<!-- <table><tr><td>0</td></tr></table> --><table><thead><tr><th></th><th colspan=3>Voting</th></tr>"
              "<tr><th>Rank<th>Player<th>First<th>Share</tr></thead>"),
        tag("tr", tag("td", rank), tag("td", tag("b", F.col("o_orderpriority"))), tag("td", "1"),
            tag("td", F.col("o_totalprice").cast("string"))),
        F.lit("</table><table><tr><td>99</td></tr></table>"))
    pages = spread(table(spark, sf_dir, "orders")).select(
        "o_orderkey", F.concat(F.lit("/awards/awards_"), F.year("o_orderdate").cast("string"), F.lit(".html")).alias("url"),
        html.alias("html"))
    return award_rows(pages, keys=["o_orderkey"])


@register("SELECT * FROM orders")
def parquet_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    overwrite_partitions(orders.withColumn("season_year", F.year("o_orderdate")), path, ["season_year"])
    write_table(read_table(spark, path).drop("season_year"), f"{path}-processed")
    return read_table(spark, f"{path}-processed")


# Names with all that a CSV file treats apart; reads alike in Spark and DuckDB.
_ODD_NAME = ("CASE s_suppkey % 6 WHEN 0 THEN s_name || ' \"Jr\", II' WHEN 1 THEN chr(10) || s_name || chr(13) || chr(10) || 'x' "
             "WHEN 2 THEN s_name || chr(92) || chr(34) WHEN 3 THEN '' WHEN 4 THEN NULL ELSE ' ' || s_name || ', ' END")


@register("SELECT s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS pos, "
          f"s_suppkey, {_ODD_NAME} AS s_name, s_acctbal FROM supplier QUALIFY pos<=10")
def csv_roundtrip(spark, sf_dir):
    top = ranking.top_n(table(spark, sf_dir, "supplier"), ["s_nationkey"],
                        [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()], 10)
    path = scratch_path(spark, "report")
    rows = top.select("s_nationkey", "pos", "s_suppkey", F.expr(_ODD_NAME).alias("s_name"), "s_acctbal")
    write_report_csv(rows, path, ["s_nationkey"])
    return read_csv(spark, path, rows.schema)


@register("SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def append_twice(spark, sf_dir):
    path = scratch_path(spark, "appended")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        append_table(rows, path)
    return read_table(spark, path)


@register("SELECT c_custkey, c_name FROM customer")
def append_new_rows(spark, sf_dir):
    path = scratch_path(spark, "appended")
    customer = table(spark, sf_dir, "customer")
    rows = customer.select("c_custkey", "c_name")
    write_table(customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), path)
    append_new(rows, path, ["c_custkey"])
    return read_table(spark, path)


@register("SELECT event_id, user_id, event_type, value FROM events")
def stream_file_ingest(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    out, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")
    source = f"{sf_dir}/events.parquet*"  # a stream's source is a folder or a pattern, not a single file
    for _ in range(2):  # the second run finds nothing new
        ingest_new_files(spark, source, schema, checkpoint, append_batches(out)).awaitTermination()
    return read_table(spark, out).select("event_id", "user_id", "event_type", "value")


@register("SELECT 'data/raw/players/' || event_type || ' ' || event_id || '.parquet' AS key FROM events "
          "UNION ALL SELECT 'data/raw/players/day=' || CAST(ts AS DATE) || '.parquet' FROM events")
def event_object_keys(spark, sf_dir):
    def record(*name):
        key = F.concat(F.lit("data/raw/"), *[F.url_encode(n.cast("string")) for n in name], F.lit(".parquet"))
        return F.struct(F.struct(F.struct(key.alias("key")).alias("object")).alias("s3"))
    notices = table(spark, sf_dir, "events").select(F.to_json(F.struct(F.array(
        record(F.concat(F.lit("players/"), "event_type", F.lit(" "), F.col("event_id").cast("string"))),
        record(F.concat(F.lit("players/day="), F.to_date("ts").cast("string"))),
        record(F.concat(F.lit("other/"), F.col("event_id").cast("string")))).alias("Records"))).alias("event"))
    return event_keys(notices)


@register("SELECT event_id, user_id, value FROM events WHERE event_type IN "
          "(SELECT event_type FROM events WHERE user_id%7=0 AND length(event_type)%2=0)")
def event_to_table(spark, sf_dir):
    """Many events name some of the objects; the objects named are appended once each."""
    events = table(spark, sf_dir, "events")
    base = scratch_path(spark, "objects")
    folder = "data/raw/players"
    events.select("event_id", "user_id", "value", "event_type").write.partitionBy("event_type").parquet(f"{base}/{folder}")
    name = F.concat(F.lit(f"{folder}/event_type="), F.col("event_type"))
    record = F.struct(F.struct(F.struct(F.url_encode(name).alias("key")).alias("object")).alias("s3"))
    notices = events.where("user_id % 7 = 0 AND length(event_type) % 2 = 0").select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("event"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    append_named_objects(notices, base, schema, lambda rows: append_table(rows, f"{base}/table"))
    return read_table(spark, f"{base}/table", schema)


# --- jobs --------------------------------------------------------------------

def _sql_list(values):
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


_LEAGUE = f"""
games AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS season_year, l_suppkey AS player, (l_suppkey+ascii(l_returnflag))%25 AS team,
  CAST(l_quantity AS BIGINT) AS pts, CAST(round(l_tax*100) AS BIGINT) AS trb, CAST(round(l_discount*100) AS BIGINT) AS ast,
  l_linenumber*8 AS mp, CASE WHEN l_linenumber<=3 THEN 1 ELSE 0 END AS gs, CASE WHEN l_linestatus='F' THEN 1 ELSE 0 END AS won
  FROM lineitem),
sums AS (SELECT season_year, player, CASE WHEN grouping(team)=1 THEN 'TOT' ELSE {_sql_list(league.CODES)}[team+1] END AS tm,
  grouping(team)=0 OR count(DISTINCT team)>1 AS keep, any_value(team) AS team, count(*) AS g, CAST(sum(gs) AS BIGINT) AS gs,
  CAST(sum(mp) AS BIGINT) AS mp, CAST(sum(pts) AS BIGINT) AS pts, CAST(sum(trb) AS BIGINT) AS trb, CAST(sum(ast) AS BIGINT) AS ast
  FROM games GROUP BY GROUPING SETS ((season_year,player,team),(season_year,player))),
stand AS (SELECT season_year, team, CAST(floor(sum(won)*40/count(*)) AS BIGINT) AS w, 1+team%18 AS seed FROM games GROUP BY 1,2),
stats AS (SELECT s.*, 'Player ' || s.player AS name, ['PG','SG','SF','PF','C'][s.player%5+1] AS pos, 19+s.player%20 AS age,
  round_even(s.pts/s.g,1) AS pts_pg, round_even(s.mp/s.g,1) AS mp_pg, round_even(s.trb/s.g,1) AS trb_pg,
  round_even(s.ast/s.g,1) AS ast_pg, s.pts+2*s.ast AS fga, round_even((s.pts+2*s.ast)/s.g,1) AS fga_pg, s.pts/(s.pts+s.mp) AS fg, round_even((s.pts+s.trb+s.ast)/s.g*0.6::DOUBLE,1) AS per,
  round_even(s.ast/40,1) AS vorp, s.pts/s.mp/48 AS ws48, t.w, 41-t.w AS l, t.seed,
  CAST(s.season_year-1 AS VARCHAR) || '-' || substr(CAST(s.season_year AS VARCHAR),3) AS season
  FROM sums s LEFT JOIN stand t ON s.season_year=t.season_year AND s.team=t.team AND s.tm<>'TOT' WHERE keep)"""


@register(f"""WITH {_LEAGUE}
SELECT name AS "Player", tm AS "Tm", pos AS "Pos", age AS "Age", g AS "G_advanced", gs AS "GS_totals", pts AS "PTS_totals",
  pts_pg AS "PTS_per_game", fg AS "FG%_totals", per AS "PER_advanced", coalesce(w,0) AS "W_team", coalesce(w/41,0) AS "W/L%_team",
  seed AS "Seed", season, TIMESTAMP '2024-01-31 10:00:00' AS snapshot_date FROM stats WHERE season_year=2000""")
def current_snapshot_job(spark, sf_dir):
    raw, _ = league.land_raw(spark, sf_dir)
    out = scratch_path(spark, "players")
    return jobs.current_snapshot(spark, raw, out, "2000", datetime(2024, 1, 31, 10)).select(
        "Player", "Tm", "Pos", "Age", "G_advanced", "GS_totals", "PTS_totals", "PTS_per_game", "FG%_totals",
        "PER_advanced", "W_team", "W/L%_team", "Seed", "season", "snapshot_date")


def _seasons(spark, raw):
    return seasons_of(spark, f"{raw}/standings")


@register(f"""WITH {_LEAGUE}
SELECT name AS "Player", tm AS "Tm", g AS "G_advanced", fga AS "FGA_totals", mp_pg AS "MP_per_game", trb_pg AS "TRB_per_game",
  vorp AS "VORP_advanced", coalesce(l,0) AS "L_team", coalesce(seed,0) AS "Seed", season FROM stats""")
def historical_seasons_job(spark, sf_dir):
    raw, _ = league.land_raw(spark, sf_dir)
    return jobs.historical_seasons(spark, raw, scratch_path(spark, "historical"), _seasons(spark, raw)).select(
        "Player", "Tm", "G_advanced", "FGA_totals", "MP_per_game", "TRB_per_game", "VORP_advanced",
        "L_team", "Seed", "season")


_VOTES = """
votes AS (SELECT season_year, player, round_even(max(pts)/1000,3) AS share,
  row_number() OVER (PARTITION BY season_year, player//64 ORDER BY max(pts) DESC, player) AS place
  FROM sums WHERE tm<>'TOT' GROUP BY 1,2 QUALIFY place<=15)"""


@register(f"""WITH {_LEAGUE}, {_VOTES}
SELECT CAST(place AS VARCHAR) AS "Rank", 'Player ' || player AS "Player", share AS "Share",
  CAST(season_year-1 AS VARCHAR) || '-' || substr(CAST(season_year AS VARCHAR),3) AS award_season FROM votes""")
def award_votes_job(spark, sf_dir):
    return jobs.award_votes(league.award_pages(league.player_seasons(spark, sf_dir)), scratch_path(spark, "awards"))


@register(f"""WITH {_LEAGUE}, {_VOTES}
SELECT name AS "Player", tm AS "Tm", season, pts AS "PTS_totals", seed AS "Seed", coalesce(share,0) AS "Share"
FROM stats LEFT JOIN votes USING(season_year, player) WHERE tm<>'TOT'""")
def training_set_job(spark, sf_dir):
    raw, rows = league.land_raw(spark, sf_dir)
    base = scratch_path(spark, "training")
    jobs.historical_seasons(spark, raw, f"{base}/historical", _seasons(spark, raw))
    jobs.award_votes(league.award_pages(rows), f"{base}/awards")
    return jobs.training_set(spark, f"{base}/historical", f"{base}/awards", f"{base}/processed", _seasons(spark, raw), strict=True).select(
        "Player", "Tm", "season", "PTS_totals", "Seed", "Share")


_JOB_SCORES = ["PTS_PERGAME", "PTS_TOTAL", "PER_ADVANCED + VORP_ADVANCED", "AST_TOTAL + TRB_TOTAL", "PTS_PERGAME * MP_PERGAME"]

_PICKED = """
picked AS (SELECT *, (82-41)/g+1 AS mult FROM stats WHERE tm<>'TOT' AND pts_pg>13.5 AND mp_pg>30 AND seed<=16 AND ast_pg>1
  AND trb_pg>3 AND fg>0.37 AND fga_pg>10 AND per>18
  QUALIFY row_number() OVER (PARTITION BY season, name ORDER BY g DESC, tm)=1),
proj AS (SELECT *, CAST(round_even(pts*mult,0) AS BIGINT) AS pts_t, CAST(round_even(ast*mult,0) AS BIGINT) AS ast_t,
  CAST(round_even(trb*mult,0) AS BIGINT) AS trb_t, round_even(vorp*mult,1) AS vorp_p FROM picked)"""
_CHOSEN = """
top AS (SELECT mo, model, season, name, round_even(share,3) AS share,
  row_number() OVER (PARTITION BY season, model ORDER BY scored.share DESC, name) AS pos FROM scored QUALIFY pos<=10),
tot AS (SELECT season, name, sum(CAST(share AS DECIMAL(18,3))) AS share_sum FROM top GROUP BY 1,2),
cand AS (SELECT season, pos, name, count(*) AS votes,
  count(*) FILTER (WHERE model IN ('SVM','Gradient Boosting','LGBM')) AS votes3, min(mo) AS seen FROM top GROUP BY 1,2,3),
pref AS (SELECT season, pos, list(name ORDER BY (votes>=3) DESC, (votes3>=2) DESC, share_sum DESC, votes DESC, seen) AS l
  FROM cand JOIN tot USING(season, name) GROUP BY 1,2),
step AS (SELECT DISTINCT season, 0::BIGINT AS pos, []::VARCHAR[] AS chosen FROM pref
  UNION ALL SELECT p.season, p.pos, list_append(s.chosen, list_filter(p.l, lambda x: NOT list_contains(s.chosen,x))[1])
  FROM step s JOIN pref p ON p.season=s.season AND p.pos=s.pos+1)"""


@register(f"""WITH RECURSIVE {_LEAGUE}, {_PICKED},
scored AS (SELECT 0 AS mo,'SVM' AS model,season,name,pts_pg AS share FROM proj
  UNION ALL SELECT 1,'Random Forest',season,name,CAST(pts_t AS DOUBLE) FROM proj
  UNION ALL SELECT 2,'AdaBoost',season,name,per+vorp_p FROM proj
  UNION ALL SELECT 3,'Gradient Boosting',season,name,CAST(ast_t+trb_t AS DOUBLE) FROM proj
  UNION ALL SELECT 4,'LGBM',season,name,pts_pg*mp_pg FROM proj), {_CHOSEN}
SELECT s.season, s.pos AS "Predicted MVP Rank", p.name AS "Player", p.pos AS "Position", p.tm AS "Team", p.age AS "Age",
  round_even(180+u.s_nationkey*1.27::DOUBLE,1) AS "Height (cm)", p.g AS "Games", p.pts_pg AS "PTS", p.trb_pg AS "REB",
  round_even(p.fg*100,2) AS "FG%", p.per AS "PER", round_even(p.ws48,3) AS "WS/48", p.vorp_p AS "VORP (Projected)",
  round_even(p.w/41,3) AS "PCT Team", p.seed AS "Seed"
FROM step s LEFT JOIN proj p ON p.season=s.season AND p.name=s.chosen[s.pos]
LEFT JOIN supplier u ON u.s_suppkey=p.player WHERE s.pos>0""")
def score_and_rank_job(spark, sf_dir):
    base = scratch_path(spark, "scored")
    layout = {k: v for k, v in S.REPORT_COLUMNS.items() if k not in ("Minutes", "AST", "STL", "BLK", "3P%", "FT%")}
    scorers = {m: scoring.expression_scorer(e) for m, e in zip(S.MODELS, _JOB_SCORES, strict=True)}
    return jobs.score_and_rank(_job_snapshot(spark, sf_dir, base), scorers, f"{base}/out", by=["season"], layout=layout)


def _job_snapshot(spark, sf_dir, base):
    raw, _ = league.land_raw(spark, sf_dir)
    history = jobs.historical_seasons(spark, raw, f"{base}/historical", _seasons(spark, raw))
    return jobs.scoring_snapshot(clean.drop_total_rows(history), league.attributes(spark, sf_dir))


# Feature, mean, deviation, and a weight for each model.
_STORED = [("PTS_PERGAME", "pts_pg", 21.37, 3.91, (0.317, 0.271, 0.113, 0.059, 0.183)),
           ("MP_PERGAME", "mp_pg", 33.11, 2.83, (0.101, 0.067, 0.211, 0.307, 0.029)),
           ("PER_ADVANCED", "per", 19.73, 4.19, (0.043, 0.131, 0.251, 0.109, 0.193))]
_INTERCEPTS = (0.37, 0.29, 0.41, 0.23, 0.31)


def _stored_score(model):
    return " + ".join([f"{_INTERCEPTS[model]}::DOUBLE"] + [
        f"({column}-{mean}::DOUBLE)/{std}::DOUBLE*{weights[model]}::DOUBLE" for _, column, mean, std, weights in _STORED])


_STORED_SCORES = " UNION ALL ".join(
    f"SELECT {i} AS mo, '{m}' AS model, season, name, {_stored_score(i)} AS share FROM proj" for i, m in enumerate(S.MODELS))
# What the names of players end with, so that rank files hold quotes, commas, backslashes and line ends.
_ENDING = "chr(34) || ', ' || chr(92) || chr(10) || chr(34)"
_TOP_COLUMNS = ", ".join(f"""max(CASE WHEN model='{m}' THEN name || {_ENDING} END) AS "MVP RANK {m}",
  max(CASE WHEN model='{m}' THEN share END) AS "MVP SHARE {m}\"""" for m in S.MODELS)


@register(f"""WITH RECURSIVE {_LEAGUE}, {_PICKED}, scored AS ({_STORED_SCORES}), {_CHOSEN}
SELECT t.season, t.pos, {_TOP_COLUMNS}, any_value(s.chosen[s.pos]) || {_ENDING} AS "MVP RANK FINAL"
FROM top t LEFT JOIN step s ON s.season=t.season AND s.pos=t.pos GROUP BY 1,2""")
def stored_models_job(spark, sf_dir):
    """Feature list, scaler and models are stored, loaded by name, and used; the wide rank files are read back."""
    base = scratch_path(spark, "stored")
    names = [f for f, *_ in _STORED]
    scoring.save_features(spark, names, f"{base}/features")
    scoring.Scaler(tuple(names), tuple(r[2] for r in _STORED), tuple(r[3] for r in _STORED)).save(spark, f"{base}/scaler")
    # Points on a plane: the regression that is stored has exactly these weights.
    for i, model in enumerate(S.MODELS):
        weights = [r[4][i] for r in _STORED]
        points = [[float(a == b) * 2 for b in range(len(names))] for a in range(len(names))] + [[0.0] * len(names), [1.0] * len(names)]
        train = spark.createDataFrame([(Vectors.dense(x), _INTERCEPTS[i] + sum(w * v for w, v in zip(weights, x))) for x in points],
                                      ["features", "label"])
        Pipeline(stages=[LinearRegression(solver="normal")]).fit(train).write().save(f"{base}/models/{model}")
    features = scoring.load_features(spark, f"{base}/features")
    scaler = scoring.Scaler.load(spark, f"{base}/scaler")
    scorers, _ = scoring.load_scorers(spark, f"{base}/models", S.MODELS, features)
    snapshot = _job_snapshot(spark, sf_dir, base).withColumn("PLAYER", F.concat("PLAYER", F.expr(_ENDING)))
    jobs.score_and_rank(snapshot, scorers, f"{base}/out", scaler, ["season"], layout={"Player": ("PLAYER", None, 1)})
    columns = [("pos", T.LongType())] + [c for m in S.MODELS for c in ((f"MVP RANK {m}", T.StringType()), (f"MVP SHARE {m}", T.DoubleType()))]
    columns += [("MVP RANK FINAL", T.StringType()), ("season", T.StringType())]
    schema = T.StructType([T.StructField(*c) for c in columns])
    return read_csv(spark, f"{base}/out/rank", schema)


# --- published, streamed, repeated -------------------------------------------

@register(f"""WITH {_LEAGUE}
SELECT name AS "Player", tm AS "Tm", pos AS "Pos", age AS "Age", g AS "G_advanced", gs AS "GS_totals", pts AS "PTS_totals",
  pts_pg AS "PTS_per_game", fg AS "FG%_totals", per AS "PER_advanced", coalesce(w,0) AS "W_team", coalesce(w/41,0) AS "W/L%_team",
  seed AS "Seed", season, TIMESTAMP '2024-01-31 10:00:00' AS snapshot_date FROM stats WHERE season_year=2000""")
def audited_publish(spark, sf_dir):
    """Two days are published; a third one repeats rows and lacks a player, so readers keep the second."""
    raw, rows = league.land_raw(spark, sf_dir)
    out = scratch_path(spark, "published")
    jobs.publish_snapshot(spark, raw, out, "1999", datetime(2024, 1, 30, 10))
    jobs.publish_snapshot(spark, raw, out, "2000", datetime(2024, 1, 31, 10))
    bad = scratch_path(spark, "raw")
    rows = rows.where("season_year = 2000")
    for info, wrong in (("totals", rows.unionByName(rows.where("player_no % 3 = 0"))), ("advanced", rows.where("player_no <> 1")), ("per_game", rows)):
        land(league.raw_stats(wrong, info), f"{bad}/stats/info={info}", ["season_year"])
    land(read_table(spark, f"{raw}/standings"), f"{bad}/standings", ["season_year"])
    try:
        jobs.publish_snapshot(spark, bad, out, "2000", datetime(2024, 2, 1, 10))
        raise AssertionError("a day with repeated rows was published")
    except quality.QualityError:
        pass
    return read_published(spark, out).select(
        "Player", "Tm", "Pos", "Age", "G_advanced", "GS_totals", "PTS_totals", "PTS_per_game", "FG%_totals",
        "PER_advanced", "W_team", "W/L%_team", "Seed", "season", "snapshot_date")


@register("SELECT event_id, user_id, value, NULL AS missing FROM events WHERE user_id%8 NOT IN (5, 6) OR user_id%8 = 5 AND event_type IN ("
          "SELECT event_type FROM events WHERE user_id%8 = 5 AND event_id%3 = 0) "
          "UNION ALL SELECT DISTINCT NULL, NULL, NULL, 'data/raw/players/absent ' || (user_id%8) FROM events WHERE event_id%3 = 0 AND user_id%8 <> 6")
def event_stream_once(spark, sf_dir):
    """Notices name objects many times, in two sets of files, and are all sent again; some name objects that are not there, some objects have none."""
    events = table(spark, sf_dir, "events")
    base, folder = scratch_path(spark, "objects"), "data/raw/players"
    named = events.withColumn("part", F.col("user_id") % 8)
    named.select("event_id", "user_id", "value", F.concat("event_type", F.lit(" "), "part").alias("object")).write.partitionBy("object").parquet(f"{base}/{folder}")

    def notices(rows, *names):
        records = F.array(*[F.struct(F.struct(F.struct(F.url_encode(n).alias("key")).alias("object")).alias("s3")) for n in names])
        return rows.select(F.to_json(F.struct(records.alias("Records"))))
    # Spaces in partition values are kept in folder names.
    key = F.concat(F.lit(f"{folder}/object="), "event_type", F.lit(" "), "part")
    first = notices(named.where("part NOT IN (5, 6)"), key)
    second = notices(named.where("event_id % 3 = 0 AND part <> 6"), key, F.concat(F.lit(f"{folder}/absent "), "part"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    out, checkpoint = f"{base}/table", f"{base}/checkpoint"
    for sent in (first, second, first, second):
        sent.write.mode("append").text(f"{base}/notices")
        land_noticed_objects(spark, f"{base}/notices", base, out, schema, checkpoint, objects=16).awaitTermination()
    return landed_objects(spark, out, schema).unionByName(
        missing_objects(spark, out).withColumnRenamed("key", "missing"), allowMissingColumns=True)


@register("SELECT CAST(ts AS DATE) AS d, user_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY "
          "max(CASE WHEN day(ts)%2=0 THEN -value ELSE value END) DESC, user_id) AS rk FROM events GROUP BY 1,2 QUALIFY rk<=10")
def rank_history_stream(spark, sf_dir):
    """Runs come in two starts; the second brings new runs, and runs of even days again, in another order."""
    events = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    base = scratch_path(spark, "ranks")

    def send(rows, number):
        best = rows.groupBy("d", "user_id").agg(F.max("value").alias("v"))
        top = ranking.top_n(best, ["d"], [F.col("v").desc(), F.col("user_id").asc()], 10)
        write_report_csv(top.select(F.date_format("d", "dd_MM_yyyy").alias("run"), "pos", "user_id"), f"{base}/sent/{number}", ["run"])
        stream_rank_history(spark, f"{base}/sent/*", f"{base}/history", schema, f"{base}/checkpoint", [F.col("pos")], "user_id").awaitTermination()
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("user_id", T.LongType())])
    even = F.dayofmonth("d") % 2 == 0
    send(events.where(even | (F.dayofmonth("d") < 10)), 1)
    send(events.where(even | (F.dayofmonth("d") >= 10)).withColumn("value", F.when(even, -F.col("value")).otherwise(F.col("value"))), 2)
    history = read_table(spark, f"{base}/history")
    return history.select(F.col("Date").alias("d"), F.col("Predicted MVP Rank").alias("user_id"), F.col("Rank").alias("rk"))


@register("SELECT c_custkey, c_name, c_mktsegment AS batch_id FROM customer WHERE c_mktsegment <> 'MACHINERY'")
def append_ledger(spark, sf_dir):
    """Batches come twice; one dies after its rows were written and never counts."""
    path = scratch_path(spark, "ledger")
    customer = table(spark, sf_dir, "customer")
    rows = customer.select("c_custkey", "c_name")
    segments = [r[0] for r in customer.select("c_mktsegment").distinct().collect()]  # five
    for segment in segments + segments:
        batch = customer.where(F.col("c_mktsegment") == segment).select("c_custkey", "c_name")
        if segment == "MACHINERY":
            write_table(batch, f"{path}/rows/batch_id={segment}")
        else:
            append_batch(batch, path, segment)
    return read_batches(spark, path, rows.schema)


@register("""
WITH raw AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus='F' THEN o_totalprice END AS share FROM orders),
kept AS (SELECT * FROM raw WHERE share IS NULL OR share > 1000),
joined AS (SELECT k.*, c.c_name FROM kept k LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment='BUILDING') c ON k.o_custkey=c.c_custkey)
SELECT 'raw' AS step, 'o_orderkey' AS "column", count(*) AS "rows", count(o_orderkey) AS non_null FROM raw
UNION ALL SELECT 'raw', 'o_custkey', count(*), count(o_custkey) FROM raw UNION ALL SELECT 'raw', 'share', count(*), count(share) FROM raw
UNION ALL SELECT 'kept', 'o_orderkey', count(*), count(o_orderkey) FROM kept UNION ALL SELECT 'kept', 'o_custkey', count(*), count(o_custkey) FROM kept
UNION ALL SELECT 'kept', 'share', count(*), count(share) FROM kept
UNION ALL SELECT 'joined', 'o_orderkey', count(*), count(o_orderkey) FROM joined UNION ALL SELECT 'joined', 'o_custkey', count(*), count(o_custkey) FROM joined
UNION ALL SELECT 'joined', 'share', count(*), count(share) FROM joined UNION ALL SELECT 'joined', 'c_name', count(*), count(c_name) FROM joined""")
def step_profile(spark, sf_dir):
    """Three steps of a job profiled while their result is written."""
    profile = StepProfile()
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("share"))
    kept = profile.step(orders, "raw").where("share IS NULL OR share > 1000")
    customer = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    joined = joins.key_join(profile.step(kept, "kept"), customer, ["o_custkey"], ["c_custkey"], "left", nulls_match=False)
    scratch_table(profile.step(joined, "joined"), "joined")
    return profile.table(spark).drop("place")


# --- stored model kinds ------------------------------------------------------

# Trees made by rule: complete, of four levels, over the projected figures of a candidate.
_TREE_FEATURES = [("PTS_PERGAME", "pts_pg", 14.0, 1.0), ("MP_PERGAME", "mp_pg", 30.0, 0.5), ("PER_ADVANCED", "per", 18.0, 0.75), ("SEED", "seed", 2.0, 1.0)]
_TREES = {"Random Forest": (12, "mean"), "AdaBoost": (9, "median"), "Gradient Boosting": (16, "sum"), "LGBM": (20, "sum")}
_LEVELS = 4
_START, _RATE = 0.5, 0.125


def _tree_sql(mo: int, model: str) -> str:
    """Scores of one model, from a recursive walk over nodes made by the same rule."""
    trees, combine = _TREES[model]
    inner = 2 ** _LEVELS - 1
    feature = f"(t.tree * 3 + w.node * 5 + {mo}) % 4"
    value = "CASE f WHEN 0 THEN pts_pg WHEN 1 THEN mp_pg WHEN 2 THEN per ELSE seed END"
    bound = "CASE f " + " ".join(f"WHEN {i} THEN {low}+{step}*((tree*7+node*3+{mo})%8)" for i, (_, _, low, step) in enumerate(_TREE_FEATURES)) + " END"
    leaf = f"((t.tree*11+w.node*13+{mo}*5)%64)/64.0::DOUBLE"
    combined = {"mean": f"sum(leaf)/{trees}", "sum": f"{_START}+sum(leaf*{_RATE})", "median": None}[combine]
    walk = f"""walk{mo} AS (
  SELECT season, name, tree, 0 AS node, 0 AS level, pts_pg, mp_pg, per, seed FROM proj, range({trees}) r(tree)
  UNION ALL SELECT season, name, tree, CASE WHEN {value} <= {bound} THEN 2*node+1 ELSE 2*node+2 END, level+1, pts_pg, mp_pg, per, seed
  FROM (SELECT w.*, {feature.replace('t.tree', 'w.tree')} AS f FROM walk{mo} w WHERE level < {_LEVELS})),
leaf{mo} AS (SELECT season, name, tree, {leaf.replace('t.tree', 'w.tree')} AS leaf FROM walk{mo} w WHERE level = {_LEVELS})"""
    if combine == "median":
        return walk + f""",
score{mo} AS (SELECT season, name, min(leaf) AS share FROM (SELECT *, sum(1+tree%3) OVER (PARTITION BY season, name ORDER BY leaf, tree) AS seen,
  sum(1+tree%3) OVER (PARTITION BY season, name) AS whole FROM leaf{mo}) WHERE seen >= 0.5*whole GROUP BY 1,2)"""
    return walk + f",\nscore{mo} AS (SELECT season, name, {combined} AS share FROM leaf{mo} GROUP BY 1,2)"


def _tree_model(spark, mo: int, model: str) -> trees.TreeModel:
    n, combine = _TREES[model]
    inner = 2 ** _LEVELS - 1
    rows = []
    for tree in range(n):
        for node in range(2 * inner + 1):
            if node < inner:
                name, _, low, step = _TREE_FEATURES[(tree * 3 + node * 5 + mo) % 4]
                rows.append((tree, node, name, low + step * ((tree * 7 + node * 3 + mo) % 8), 2 * node + 1, 2 * node + 2, None, None))
            else:
                rows.append((tree, node, None, None, None, None, None, ((tree * 11 + node * 13 + mo * 5) % 64) / 64.0))
    weights = {"mean": (), "sum": (_RATE,) * n, "median": tuple(1.0 + t % 3 for t in range(n))}[combine]
    return trees.TreeModel(spark.createDataFrame(rows, trees.NODES), tuple(f for f, *_ in _TREE_FEATURES), combine, _START if combine == "sum" else 0.0, weights)


@register(f"""WITH RECURSIVE {_LEAGUE}, {_PICKED},
{", ".join(_tree_sql(i, m) for i, m in enumerate(_TREES))},
scored AS ({" UNION ALL ".join(f"SELECT '{m}' AS model, season, name, share FROM score{i}" for i, m in enumerate(_TREES))})
SELECT season, model, name AS player, round_even(share,6) AS share, row_number() OVER (PARTITION BY season, model ORDER BY share DESC, name) AS pos
FROM scored""")
def tree_models_job(spark, sf_dir):
    """A forest, a resampling and two gradient boosted ensembles, stored, loaded, and scored; every candidate ranked per model."""
    base = scratch_path(spark, "trees")
    scorers = {}
    for mo, model in enumerate(_TREES):
        trees.save_trees(_tree_model(spark, mo, model), f"{base}/{model}")
        scorers[model] = trees.tree_scorer(trees.load_trees(spark, f"{base}/{model}"))
    projected, scores, _ = jobs.scored_candidates(_job_snapshot(spark, sf_dir, base), None, scorers, ["season"])
    ranked = ranking.rank_models(scores, ["season"], "PLAYER", players=projected)
    return ranked.select("season", "model", F.col("PLAYER").alias("player"), np_round(F.col("share"), 6).alias("share"), "pos")


@register(f"""WITH {_FEAT},
scaled AS (SELECT player, (qty-1500)/500 AS a, (n-60)/20 AS b, bal/5000 AS c FROM feat),
support AS (SELECT a, b, c, ((player*7)%11-5)/8 AS w FROM scaled WHERE player % 5 = 0 AND player <= 400)
SELECT f.player, round_even(0.25::DOUBLE + sum(w*exp(-0.5::DOUBLE*((f.a-s.a)*(f.a-s.a)+(f.b-s.b)*(f.b-s.b)+(f.c-s.c)*(f.c-s.c)))), 6) AS rbf,
  round_even(0.25::DOUBLE + sum(w*power(0.5::DOUBLE*(f.a*s.a+f.b*s.b+f.c*s.c)+1, 2)), 6) AS poly
FROM scaled f, support s GROUP BY f.player""")
def kernel_scores(spark, sf_dir):
    """A radial and a polynomial kernel machine over support vectors taken from the table; the second one in several blocks."""
    scaled = scratch_table(_feat(spark, sf_dir).select("player", ((F.col("qty") - 1500) / 500).alias("a"), ((F.col("n") - 60) / 20).alias("b"),
                                                       (F.col("bal") / 5000).alias("c")), "scaled")
    support = scaled.where("player % 5 = 0 AND player <= 400").select(
        F.array("a", "b", "c").alias("vector"), (((F.col("player") * 7) % 11 - 5) / 8).alias("coefficient"))
    rbf = kernels.KernelModel(support, ("a", "b", "c"), "rbf", gamma=0.5, intercept=0.25)
    poly = kernels.KernelModel(support, ("a", "b", "c"), "poly", gamma=0.5, degree=2, offset=1.0, intercept=0.25)
    scored = kernels.kernel_scorer(poly, block_bytes=2_048)(kernels.kernel_scorer(rbf)(scaled, "rbf"), "poly")
    return scored.select("player", np_round(F.col("rbf"), 6).alias("rbf"), np_round(F.col("poly"), 6).alias("poly"))
