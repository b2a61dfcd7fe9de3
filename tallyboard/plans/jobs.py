"""The six jobs, composed from the operators. Paths, dates and models are parameters."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyboard import schemas as S
from tallyboard.operators import clean, joins, quality, ranking, scoring
from tallyboard.session import scratch_path, scratch_table
from tallyboard.sinks import append_jdbc, overwrite_partitions, publish, read_published, write_rank_csv, write_report_csv, write_table
from tallyboard.sources import (award_rows, read_awards, read_dated_ranks, read_player_stats, read_seasons,
                                read_standings, read_table)
from tallyboard.streaming import BatchSink, ingest_new_files

log = logging.getLogger(__name__)

_YEAR = "season_year"


def _season_stats(spark: SparkSession, raw: str, seasons: Iterable[str | int]) -> DataFrame:
    """Checked, joined stats with standings for all listed seasons at once."""
    seasons = [str(s) for s in seasons]
    tables = [clean.clean_player_stats(read_player_stats(spark, raw, info, seasons), info, [_YEAR])
              for info in S.INFOS]
    quality.check_stats(tables, [_YEAR])
    # Pos and Age come once: only the advanced table still has them.
    stats = joins.merge_stats(tables, [_YEAR, *S.STATS_KEY])
    standings = clean.clean_standings(read_standings(spark, raw, seasons), [_YEAR])
    return joins.with_standings(stats, standings, [_YEAR, "Tm"])


def current_snapshot(spark: SparkSession, raw: str, out: str, season: str, at: datetime) -> DataFrame:
    """Land one day's snapshot of the running season under ``out``; a re-run replaces that day."""
    stats = _season_stats(spark, raw, [season])
    stats = clean.add_season(clean.add_snapshot_date(stats, at), F.col(_YEAR)).drop(_YEAR)
    stats = clean.enforce_types(stats, S.COLUMN_TYPES)
    stats = stats.withColumn("snapshot_day", F.lit(at.strftime("%Y_%m_%d")))
    overwrite_partitions(stats, out, ["snapshot_day"], gather=False)
    return snapshot_of(spark, out, at.strftime("%Y_%m_%d"), stats.schema)


def snapshot_of(spark: SparkSession, out: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One landed day; the other days' files are not opened."""
    return read_table(spark, out, schema).where(F.col("snapshot_day") == day)


def publish_snapshot(spark: SparkSession, raw: str, out: str, season: str, at: datetime) -> DataFrame:
    """Publish one day's snapshot under ``out``, audited by what is counted while it is written.

    Each stats table is read once: the rules of ``check_stats`` are observed on the join
    itself. If one fails, ``QualityError`` says which, and readers keep the day before.
    """
    tables = [clean.clean_player_stats(read_player_stats(spark, raw, info, [season]), info, [_YEAR]) for info in S.INFOS]
    stats, watch = joins.merge_stats_watched(tables, [_YEAR, *S.STATS_KEY], [_YEAR, "Player"])
    standings = clean.clean_standings(read_standings(spark, raw, [season]), [_YEAR])
    stats = joins.with_standings(stats, standings, [_YEAR, "Tm"])
    stats = clean.add_season(clean.add_snapshot_date(stats, at), F.col(_YEAR)).drop(_YEAR)
    stats = clean.enforce_types(stats, S.COLUMN_TYPES)
    publish(stats, out, {"rows_without_player": F.count_if(F.col("Player").isNull())}, watch)
    return read_published(spark, out, stats.schema)


def publish_training_set(spark: SparkSession, history: str, awards: str, out: str, seasons: Iterable[str | int]) -> DataFrame:
    """``training_set`` in its strict form, published after its audit: votes without stats are counted in the join itself."""
    seasons = [str(s) for s in seasons]
    stats = clean.drop_total_rows(read_seasons(spark, history, seasons)).drop(_YEAR)
    votes = read_awards(spark, awards).where(F.col("award_season").isin([f"{int(s[:4]) - 1}-{s[2:4]}" for s in seasons]))
    labelled, watch = joins.with_awards_watched(stats, votes)
    typed = clean.enforce_types(clean.fill_share(labelled), S.TRAINING_TYPES)
    publish(typed, out, watched=watch)
    return read_published(spark, out, typed.schema)


def historical_seasons(spark: SparkSession, raw: str, out: str, seasons: Iterable[str | int]) -> DataFrame:
    """Land all listed seasons in one job, one partition per season."""
    seasons = [str(s) for s in seasons]
    stats = clean.fill_zero(_season_stats(spark, raw, seasons))
    stats = clean.add_season(stats, F.col(_YEAR))
    stats = clean.enforce_types(stats, S.COLUMN_TYPES, fill="all")
    overwrite_partitions(stats, out, [_YEAR])
    return read_seasons(spark, out, seasons, stats.schema)


def award_votes(pages: DataFrame, out: str) -> DataFrame:
    """Extract the vote table of every award page and land them as one table."""
    write_table(award_rows(pages), out)
    return read_table(pages.sparkSession, out, S.AWARD_SCHEMA)


def training_set(spark: SparkSession, history: str, awards: str, out: str,
                 seasons: Iterable[str | int], strict: bool = False) -> DataFrame:
    """Historical stats labelled with award shares.

    Every award player of the listed seasons must occur in the stats, else the
    job stops before it writes.
    """
    seasons = [str(s) for s in seasons]
    labels = [f"{int(s[:4]) - 1}-{s[2:4]}" for s in seasons]
    stats = clean.drop_total_rows(read_seasons(spark, history, seasons)).drop(_YEAR)
    votes = read_awards(spark, awards)
    if not quality.names_match(votes, stats, labels, strict):
        path = scratch_path(spark, "missing_players")
        write_table(quality.missing_players(votes.where(F.col("award_season").isin(labels)), stats, strict), path)
        listed = read_table(spark, path)
        raise quality.QualityError(f"{listed.count()} award votes name players that the stats lack, "
                                   f"such as {' '.join(listed.first())}; all of them are listed in {path}")
    labelled, counts = clean.observed(joins.with_awards(stats, votes), "training_set", ["Share"])
    typed = clean.enforce_types(clean.fill_share(labelled), S.TRAINING_TYPES)
    write_table(typed, out)
    log.info("%s rows, %s of them with a share", counts.get["rows"], counts.get["Share"])
    return read_table(spark, out, typed.schema)


def ingest_batch(spark: SparkSession, snapshots: str, day: str, url: str, table: str,
                 properties: Mapping[str, str] | None = None) -> None:
    """Append one landed day to the relational table."""
    append_jdbc(snapshot_of(spark, snapshots, day).drop("snapshot_day"), url, table, properties)


def ingest_stream(spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str, sink: BatchSink,
                  glob: str = "*.parquet") -> None:
    """Append every file landed since the last run, then stop."""
    ingest_new_files(spark, folder, schema, checkpoint, sink, glob).awaitTermination()


def scoring_snapshot(landed: DataFrame, attributes: DataFrame) -> DataFrame:
    """A landed snapshot under the scoring job's names, with the players' attributes joined."""
    return joins.key_join(clean.scoring_names(landed), joins.broadcast_if_small(attributes),
                          ["PLAYER"], ["PLAYER"], "left")


def scored_candidates(snapshot: DataFrame, scaler: scoring.Scaler | None,
                      scorers: Mapping[str, scoring.Scorer], by: Sequence[str] = (),
                      on_error: str = "raise", **projection) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Candidates with projected figures, their scores per model, and the models skipped.

    A traded player has one row per team; the row with most games stays. The
    candidates are written once, for the scores and for the report.
    """
    chosen = clean.candidates(clean.to_number(snapshot, "PER_ADVANCED"))
    chosen = ranking.one_row_per_player(chosen, [*by, "PLAYER"], [F.col("G").desc(), F.col("TEAM").asc()])
    projected = scratch_table(clean.project_season(chosen, **projection), "projected")
    features = scaler.transform(projected) if scaler else projected
    scores, skipped = scoring.score_models(features, scorers, [*by, "PLAYER"], on_error)
    return projected, scores, skipped


def score_and_rank(snapshot: DataFrame, scorers: Mapping[str, scoring.Scorer], out: str,
                   scaler: scoring.Scaler | None = None, by: Sequence[str] = (), n: int = 10,
                   on_error: str = "raise", layout: Mapping[str, tuple[str, int | None, int]] = S.REPORT_COLUMNS,
                   **projection) -> DataFrame:
    """Score candidates, merge the models' top-n into one order, write rank table and report.

    ``by`` are the columns that tell runs apart, such as the snapshot date; all
    runs are ranked in one job. Returns the report as written: candidates are
    projected once, and whoever reads the report runs none of the job again.
    """
    spark = snapshot.sparkSession
    projected, scores, skipped = scored_candidates(snapshot, scaler, scorers, by, on_error, **projection)
    models = [m for m in scorers if m not in skipped]
    # Ranks are written before they are used twice: n rows per model and run.
    best = ranking.top_models(scores, n, by, "PLAYER")
    write_table(best, f"{out}/top")
    top = read_table(spark, f"{out}/top", best.schema)
    final = ranking.consensus(top, by, "PLAYER", n)
    wide = ranking.wide_ranks(top, models, by, "PLAYER").join(
        final.select(*by, F.col("final_rank").alias("pos"), F.col("PLAYER").alias("MVP RANK FINAL")),
        [*by, "pos"], "left")
    write_rank_csv(wide, f"{out}/rank", by)
    # Candidates hold one row per player already.
    report = scratch_table(final_report(final, projected, by, layout, validate=False), "report")
    write_report_csv(report, f"{out}/report", by)
    return report


def final_report(final: DataFrame, stats: DataFrame, by: Sequence[str] = (),
                 layout: Mapping[str, tuple[str, int | None, int]] = S.REPORT_COLUMNS,
                 player: str = "PLAYER", validate: bool | str = True) -> DataFrame:
    """Final order left join stats, one row on each side per player, as report columns.

    ``validate="plan"`` makes the report itself raise, while it is computed, when either side
    repeats a player, and name the player; nothing runs before. ``validate=True`` looks for
    repeated players at once. In that case, and without any check, the final order, a top-n
    list per run, is written once, and when it measures small it goes to the stats scan as a
    broadcast filter, so that only its players' rows are joined.
    """
    keys = [*by, player]
    if validate == "plan":
        # Positions without a player are no players that repeat.
        named = joins.one_to_one(final.where(F.col(player).isNotNull()), stats, keys, "left", ("final ranks", "stats"))
        joined = named.unionByName(final.where(F.col(player).isNull()), allowMissingColumns=True)
    else:
        final = scratch_table(final, "final")
        ranked = final.where(F.col(player).isNotNull())
        if validate:
            quality.assert_unique(ranked, keys, "final ranks")
            quality.assert_unique(stats, keys, "stats")
        stats = stats.join(joins.broadcast_if_small(ranked.select(*keys)), keys, "left_semi")
        joined = joins.key_join(final, stats, keys, keys, "left")
    return clean.report_columns(joined.withColumnRenamed("final_rank", S.REPORT_RANK), layout,
                                [*by, S.REPORT_RANK])


def rank_evolution(spark: SparkSession, ranks: str, out: str, order: str = "pos",
                   player: str = "MVP RANK FINAL", **reading) -> DataFrame:
    """Collect the rank files of all dated runs into one history, landed by date.

    Only the runs found are replaced, so the history can grow run by run.
    """
    dated = read_dated_ranks(spark, ranks, **reading)
    history = ranking.rank_history(dated, "run_date", [F.col(order).cast("int")], player)
    overwrite_partitions(history, out, ["Date"])
    return read_table(spark, out)
