"""Column names, types and lookup values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal what the landed data and its users expect.
# ---------------------------------------------------------------------------

INFOS = ("totals", "advanced", "per_game")

# Columns dropped from each raw stats table, besides Season.
DROPPED = {
    "per_game": ["G", "GS", "Pos", "Age"],
    "totals": ["MP", "G", "Pos", "Age"],
    "advanced": [],
}

# Columns that get no suffix.
UNSUFFIXED = {
    "per_game": ["Player", "Tm"],
    "totals": ["Player", "Tm", "Pos", "Age"],
    "advanced": ["Player", "Tm", "Pos", "Age", "Season"],
    "team": ["Tm", "Seed"],
}

STATS_KEY = ["Player", "Tm"]
TOTAL_ROW = "TOT"
SEASON_GAMES = 82
AWARD_URL_YEAR = r"awards_(\d{4})"

TEAM_CODES = {
    "Utah Jazz": "UTA",
    "Phoenix Suns": "PHO",
    "Philadelphia 76ers": "PHI",
    "Brooklyn Nets": "BRK",
    "Denver Nuggets": "DEN",
    "Los Angeles Clippers": "LAC",
    "Milwaukee Bucks": "MIL",
    "Dallas Mavericks": "DAL",
    "Los Angeles Lakers": "LAL",
    "Portland Trail Blazers": "POR",
    "Atlanta Hawks": "ATL",
    "New York Knicks": "NYK",
    "Miami Heat": "MIA",
    "Golden State Warriors": "GSW",
    "Memphis Grizzlies": "MEM",
    "Boston Celtics": "BOS",
    "Washington Wizards": "WAS",
    "Indiana Pacers": "IND",
    "Charlotte Hornets": "CHO",
    "Charlotte Bobcats": "CHA",
    "San Antonio Spurs": "SAS",
    "Chicago Bulls": "CHI",
    "New Orleans Pelicans": "NOP",
    "Sacramento Kings": "SAC",
    "Toronto Raptors": "TOR",
    "Minnesota Timberwolves": "MIN",
    "Cleveland Cavaliers": "CLE",
    "Oklahoma City Thunder": "OKC",
    "Orlando Magic": "ORL",
    "Detroit Pistons": "DET",
    "Houston Rockets": "HOU",
    "New Jersey Nets": "NJN",
    "New Orleans Hornets": "NOH",
    "Seattle SuperSonics": "SEA",
}

DIVISIONS = [
    "Southwest Division", "Atlantic Division", "Central Division",
    "Southeast Division", "Northwest Division", "Pacific Division",
]

# Landed column types.
COLUMN_TYPES = {
    "Player": "string", "Tm": "string", "MP": "double", "Pos": "string", "Age": "bigint",
    "G_advanced": "bigint",
    "W_team": "bigint", "L_team": "bigint", "W/L%_team": "double", "PS/G_team": "double",
    "PA/G_team": "double", "SRS_team": "double", "Seed_team": "bigint",
    "PER_advanced": "double", "TS%_advanced": "double", "3PAr_advanced": "double",
    "FTr_advanced": "double", "ORB%_advanced": "double", "DRB%_advanced": "double",
    "TRB%_advanced": "double", "AST%_advanced": "double", "STL%_advanced": "double",
    "BLK%_advanced": "double", "TOV%_advanced": "double", "USG%_advanced": "double",
    "OWS_advanced": "double", "DWS_advanced": "double", "WS_advanced": "double",
    "WS/48_advanced": "double", "OBPM_advanced": "double", "DBPM_advanced": "double",
    "BPM_advanced": "double", "VORP_advanced": "double",
    "GS_totals": "bigint", "FG_totals": "bigint", "FGA_totals": "bigint", "FG%_totals": "double",
    "3P_totals": "bigint", "3PA_totals": "bigint", "3P%_totals": "double",
    "2P_totals": "bigint", "2PA_totals": "bigint", "2P%_totals": "double", "eFG%_totals": "double",
    "FT_totals": "bigint", "FTA_totals": "bigint", "FT%_totals": "double",
    "ORB_totals": "bigint", "DRB_totals": "bigint", "TRB_totals": "bigint",
    "AST_totals": "bigint", "STL_totals": "bigint", "BLK_totals": "bigint",
    "TOV_totals": "bigint", "PF_totals": "bigint", "PTS_totals": "bigint",
    "MP_per_game": "double", "FG_per_game": "double", "FGA_per_game": "double",
    "FG%_per_game": "double", "3P_per_game": "double", "3PA_per_game": "double",
    "3P%_per_game": "double", "2P_per_game": "double", "2PA_per_game": "double",
    "2P%_per_game": "double", "eFG%_per_game": "double", "FT_per_game": "double",
    "FTA_per_game": "double", "FT%_per_game": "double", "ORB_per_game": "double",
    "DRB_per_game": "double", "TRB_per_game": "double", "AST_per_game": "double",
    "STL_per_game": "double", "BLK_per_game": "double", "TOV_per_game": "double",
    "PF_per_game": "double", "PTS_per_game": "double",
    "snapshot_date": "timestamp_ntz", "season": "string",
}
# Names the data really carries beside MP and Seed_team: typed, but a missing seed
# stays missing, which is what keeps season-total rows out of the candidates.
CAST_ONLY = {"MP_advanced": "double", "Seed": "bigint"}
TRAINING_TYPES = {**COLUMN_TYPES, "Share": "double"}

# Candidate thresholds: all must hold.
CANDIDATE_ABOVE = {
    "PTS_PERGAME": 13.5, "MP_PERGAME": 30, "AST_PERGAME": 1, "TRB_PERGAME": 3,
    "FG%": 0.37, "FGA_PERGAME": 10, "PER_ADVANCED": 18,
}
CANDIDATE_AT_MOST = {"SEED": 16}

# Columns cast to whole numbers after the season projection, besides every *_TOTAL.
WHOLE_COLUMNS = ["AGE", "G", "GS", "EXPERIENCE", "COLLEGE", "NATIONALITY_US", "SEED"]
PROJECTED_ADVANCED = ["OWS_ADVANCED", "DWS_ADVANCED", "WS_ADVANCED", "VORP_ADVANCED"]

MODELS = ["SVM", "Random Forest", "AdaBoost", "Gradient Boosting", "LGBM"]
TIE_BREAK_MODELS = ["SVM", "Gradient Boosting", "LGBM"]

# Report column -> (source column, decimals or None, factor).
REPORT_COLUMNS = {
    "Player": ("PLAYER", None, 1), "Position": ("POS", None, 1), "Team": ("TEAM", None, 1),
    "Age": ("AGE", None, 1), "Height (cm)": ("HEIGHT", 1, 1), "Games": ("G", None, 1),
    "Minutes": ("MP_PERGAME", None, 1), "PTS": ("PTS_PERGAME", None, 1),
    "REB": ("TRB_PERGAME", None, 1), "AST": ("AST_PERGAME", None, 1),
    "STL": ("STL_PERGAME", None, 1), "BLK": ("BLK_PERGAME", None, 1),
    "FG%": ("FG%", 2, 100), "3P%": ("3P%", 2, 100), "FT%": ("FT%", 2, 100),
    "PER": ("PER_ADVANCED", None, 1), "WS/48": ("WS/48_ADVANCED", 3, 1),
    "VORP (Projected)": ("VORP_ADVANCED", None, 1), "PCT Team": ("PCT", 3, 1),
    "Seed": ("SEED", None, 1),
}
REPORT_RANK = "Predicted MVP Rank"

# ---------------------------------------------------------------------------

AWARD_SCHEMA = T.StructType([
    T.StructField("Rank", T.StringType()),
    T.StructField("Player", T.StringType()),
    T.StructField("Share", T.DoubleType()),
    T.StructField("award_season", T.StringType()),
])
