from tallyboard.sources.census import SchemaDriftError
from tallyboard.sources.html_tables import award_rows, first_tables
from tallyboard.sources.landed import (read_awards, read_player_stats, read_seasons, read_standings, read_table, seasons_of,
                                       union_seasons)
from tallyboard.sources.ranks import read_csv, read_dated_ranks

__all__ = ["SchemaDriftError", "award_rows", "first_tables", "read_awards", "read_csv", "read_dated_ranks", "read_player_stats",
           "read_seasons", "read_standings", "read_table", "seasons_of", "union_seasons"]
