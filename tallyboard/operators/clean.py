"""Column shaping, filters and type enforcement. Every function maps a DataFrame to a DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tallyboard import schemas as S
from tallyboard.functions import above, differs, not_in, np_round, required, season_label, strip_marker

log = logging.getLogger(__name__)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must exist; a plain ``drop`` would pass over a misspelt one."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*columns)


def add_suffix(df: DataFrame, suffix: str, keep: Sequence[str]) -> DataFrame:
    """Append a suffix to every column name not in ``keep``."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keep})


def strip_column(df: DataFrame, column: str, marker: str = "*") -> DataFrame:
    return df.withColumn(column, strip_marker(F.col(column), marker))


def lookup_code(df: DataFrame, column: str, codes: Mapping[str, str]) -> DataFrame:
    """Replace whole values found in a fixed map; other values pass through."""
    return df.replace(dict(codes), subset=[column])


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(not_in(F.col(column), values))


def drop_total_rows(df: DataFrame, column: str = "Tm", total: str = S.TOTAL_ROW) -> DataFrame:
    """Drop the season-total row of players with several teams; their team rows stay."""
    return df.where(differs(F.col(column), total))


def clean_player_stats(df: DataFrame, info: str, season_keys: Sequence[str] = ()) -> DataFrame:
    """One raw stats table to its joinable form.

    ``season_keys`` are columns that stay unsuffixed when several seasons go
    through in one job.
    """
    df = drop_columns(df, S.DROPPED[info] + ["Season"])
    df = add_suffix(df, f"_{info}", [*S.UNSUFFIXED[info], *season_keys])
    return strip_column(df, "Player")


def clean_standings(df: DataFrame, season_keys: Sequence[str] = ()) -> DataFrame:
    """Raw standings to one row per team code, without division header rows."""
    df = exclude_values(strip_column(df, "Tm"), "Tm", S.DIVISIONS)
    return add_suffix(lookup_code(df, "Tm", S.TEAM_CODES), "_team",
                      [*S.UNSUFFIXED["team"], *season_keys])


def add_snapshot_date(df: DataFrame, at: datetime) -> DataFrame:
    """The run's timestamp is a job parameter, so a re-run gives the same rows.

    It goes in as text: a timestamp literal would pass through two time zones.
    """
    return df.withColumn("snapshot_date", F.lit(at.isoformat(" ")).cast("timestamp_ntz"))


def add_season(df: DataFrame, year: str | Column) -> DataFrame:
    return df.withColumn("season", season_label(F.lit(year) if isinstance(year, str) else year))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN to zero (text: ``"0"``, time: the epoch); all columns by default."""
    wanted = list(df.columns if columns is None else columns)
    times = [f.name for f in df.schema.fields if f.name in wanted
             and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    filled = df.na.fill(0, wanted).na.fill("0", wanted)
    return filled.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("1970-01-01").cast(df.schema[c].dataType))
                               for c in times}) if times else filled


def enforce_types(df: DataFrame, column_types: Mapping[str, str], fill: str = "declared",
                  cast_only: Mapping[str, str] = S.CAST_ONLY) -> DataFrame:
    """Fill missing values with zero, then cast, in one projection.

    ``fill="declared"`` fills only declared columns, ``"all"`` fills the others
    as well. Columns of ``cast_only`` are cast without a fill of their own.
    Declared columns that are absent are logged; undeclared ones pass through
    uncast. A value that cannot be cast raises (ANSI casts).
    """
    for name in column_types:
        if name not in df.columns:
            log.info("column %r not found", name)
    filled = fill_zero(df, None if fill == "all" else [c for c in df.columns if c in column_types])
    targets = {**cast_only, **column_types}
    return filled.selectExpr(*[f"CAST(`{c}` AS {targets[c]}) AS `{c}`" if c in targets else f"`{c}`"
                               for c in df.columns])


def fill_share(df: DataFrame) -> DataFrame:
    """After the award join: players without votes get share 0; the award's own labels go."""
    return fill_zero(df, ["Share"]).drop("award_season", "Rank")


def to_number(df: DataFrame, column: str) -> DataFrame:
    """Text to double; unparsable text raises."""
    return df.withColumn(column, F.col(column).cast("double"))


def observed(df: DataFrame, name: str, not_null: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """Row and non-null counts, gathered while the first action on the result runs."""
    watch = Observation(name)
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in not_null]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), watch


def candidates(df: DataFrame, minimum: Mapping[str, float] = S.CANDIDATE_ABOVE,
               at_most: Mapping[str, float] = S.CANDIDATE_AT_MOST) -> DataFrame:
    """Rows above every bound of ``minimum`` and not beyond any bound of ``at_most``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    tests = [above(F.col(c), bound, isinstance(types[c], (T.DoubleType, T.FloatType)))
             for c, bound in minimum.items()]
    tests += [F.col(c) <= F.lit(bound) for c, bound in at_most.items()]
    return df.where(reduce(and_, tests))


def project_season(df: DataFrame, games: int = S.SEASON_GAMES,
                   totals: Sequence[str] | None = None,
                   advanced: Sequence[str] = S.PROJECTED_ADVANCED,
                   whole: Sequence[str] = S.WHOLE_COLUMNS) -> DataFrame:
    """Scale totals and cumulative advanced figures to a full season.

    Totals are rounded to whole numbers and cast, advanced figures keep one
    decimal, ``whole`` columns are cast. A null where a whole number is needed
    raises.
    """
    totals = [c for c in df.columns if c.endswith("_TOTAL")] if totals is None else list(totals)
    df = df.withColumn("G_LEFT", F.lit(games) - F.col("G_TEAM"))
    df = df.withColumn("MULT_G", F.try_divide(F.col("G_LEFT"), F.col("G")) + F.lit(1))

    def integer(c: Column, name: str) -> Column:
        return required(c, f"no whole number in {name}").cast("bigint")

    scaled = {c: integer(np_round(F.col(c) * F.col("MULT_G"), 0), c) for c in totals}
    scaled |= {c: integer(F.col(c), c) for c in whole}
    scaled |= {c: np_round(F.col(c) * F.col("MULT_G"), 1) for c in advanced}
    return df.withColumns(scaled)


def report_columns(df: DataFrame, layout: Mapping[str, tuple[str, int | None, int]] = S.REPORT_COLUMNS,
                   leading: Sequence[str] = (S.REPORT_RANK,)) -> DataFrame:
    """Select, scale, round and rename the report's columns."""
    out = [F.col(f"`{c}`") for c in leading]
    for name, (source, digits, factor) in layout.items():
        c = F.col(f"`{source}`")
        c = c if factor == 1 else c * F.lit(factor)
        out.append((c if digits is None else np_round(c, digits)).alias(name))
    return df.select(*out)


# Scoring names for landed columns; the columns left over here are matched by suffix.
_SCORING_NAMES = {
    "Player": "PLAYER", "Tm": "TEAM", "Pos": "POS", "Age": "AGE", "Seed": "SEED",
    "G_advanced": "G", "GS_totals": "GS", "W/L%_team": "PCT", "FG%_totals": "FG%",
    "3P%_totals": "3P%", "FT%_totals": "FT%",
}
_SCORING_SUFFIXES = {"_totals": "_TOTAL", "_per_game": "_PERGAME", "_advanced": "_ADVANCED"}


def scoring_names(df: DataFrame) -> DataFrame:
    """Landed snapshot names to the names the scoring job uses."""
    names = {c: _SCORING_NAMES[c] for c in df.columns if c in _SCORING_NAMES}
    for c in df.columns:
        for old, new in _SCORING_SUFFIXES.items():
            if c not in names and c.endswith(old):
                names[c] = c.removesuffix(old).upper() + new
    out = [F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns]
    if {"W_team", "L_team"} <= set(df.columns):
        out.append((F.col("W_team") + F.col("L_team")).alias("G_TEAM"))
    return df.select(*out)
