"""Declared tables, their keys, and the payload names each column may arrive under."""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- Fixed values: declared tables -------------------------------------------------
# Ids of teams and players are LONG because the payloads carry 64-bit integers;
# game ids are text because their leading zeros matter.

TABLE_DDL = {
    "teams": (
        "team_id LONG, abbreviation STRING, nickname STRING, city STRING, state STRING, "
        "year_founded INT, arena STRING"
    ),
    "players": (
        "player_id LONG, full_name STRING, first_name STRING, last_name STRING, "
        "is_active BOOLEAN, school STRING, country STRING, height STRING, weight STRING, "
        "draft_year STRING, draft_round STRING, draft_number STRING"
    ),
    "games": (
        "game_id STRING, game_date DATE, season_id STRING, matchup STRING, "
        "home_team_id LONG, away_team_id LONG, home_pts INT, away_pts INT"
    ),
    "player_game_stats": (
        "game_id STRING, player_id LONG, team_id LONG, minutes STRING, "
        "pts INT, reb INT, ast INT, stl INT, blk INT, tov INT, pf INT, plus_minus DOUBLE, "
        "fgm INT, fga INT, fg_pct DOUBLE, fg3m INT, fg3a INT, fg3_pct DOUBLE, "
        "ftm INT, fta INT, ft_pct DOUBLE, off_rating DOUBLE, def_rating DOUBLE, "
        "net_rating DOUBLE, usg_pct DOUBLE, pace DOUBLE, pie DOUBLE"
    ),
    "play_by_play": (
        "game_id STRING, event_num INT, period INT, clock STRING, team_id LONG, "
        "player_id LONG, action_type STRING, sub_type STRING, description STRING, "
        "shot_result STRING, loc_x INT, loc_y INT, margin INT, score_home STRING, "
        "score_away STRING"
    ),
    "hustle_stats": (
        "game_id STRING, player_id LONG, team_id LONG, screen_assists INT, deflections INT, "
        "loose_balls_recovered INT, charges_drawn INT, contested_shots INT, box_outs INT"
    ),
    "tracking_stats": (
        "game_id STRING, player_id LONG, dist_miles DOUBLE, avg_speed DOUBLE, "
        "avg_speed_off DOUBLE, avg_speed_def DOUBLE"
    ),
    "game_rotations": (
        "row_id LONG, game_id STRING, player_id LONG, team_id LONG, in_time_real DOUBLE, "
        "out_time_real DOUBLE, pt_diff DOUBLE"
    ),
    "player_matchups": (
        "game_id STRING, team_id LONG, off_player_id LONG, def_player_id LONG, "
        "matchup_minutes DOUBLE, points_allowed INT, matchup_ast INT, matchup_tov INT, "
        "matchup_blk INT"
    ),
    "line_scores": (
        "GAME_DATE_EST STRING, GAME_ID STRING, TEAM_ID LONG, TEAM_ABBREVIATION STRING, "
        "PTS_QTR1 INT, PTS_QTR2 INT, PTS_QTR3 INT, PTS_QTR4 INT, "
        "PTS_OT1 INT, PTS_OT2 INT, PTS_OT3 INT, PTS_OT4 INT, PTS_OT5 INT, "
        "PTS_OT6 INT, PTS_OT7 INT, PTS_OT8 INT, PTS_OT9 INT, PTS_OT10 INT, PTS INT"
    ),
}

TABLE_KEYS = {
    "teams": ["team_id"],
    "players": ["player_id"],
    "games": ["game_id"],
    "player_game_stats": ["game_id", "player_id"],
    "play_by_play": ["game_id", "event_num"],
    "hustle_stats": ["game_id", "player_id"],
    "tracking_stats": ["game_id", "player_id"],
    "game_rotations": ["game_id", "row_id"],
    "player_matchups": ["game_id", "off_player_id", "def_player_id"],
    "line_scores": ["GAME_ID", "TEAM_ID"],
}

# (table, column) -> (dimension table, its key)
FOREIGN_KEYS = {
    ("games", "home_team_id"): ("teams", "team_id"),
    ("games", "away_team_id"): ("teams", "team_id"),
    ("player_game_stats", "game_id"): ("games", "game_id"),
    ("player_game_stats", "player_id"): ("players", "player_id"),
    ("player_game_stats", "team_id"): ("teams", "team_id"),
    ("play_by_play", "game_id"): ("games", "game_id"),
    ("play_by_play", "team_id"): ("teams", "team_id"),
    ("play_by_play", "player_id"): ("players", "player_id"),
    ("hustle_stats", "game_id"): ("games", "game_id"),
    ("hustle_stats", "player_id"): ("players", "player_id"),
    ("hustle_stats", "team_id"): ("teams", "team_id"),
    ("tracking_stats", "game_id"): ("games", "game_id"),
    ("tracking_stats", "player_id"): ("players", "player_id"),
    ("game_rotations", "game_id"): ("games", "game_id"),
    ("game_rotations", "player_id"): ("players", "player_id"),
    ("game_rotations", "team_id"): ("teams", "team_id"),
    ("player_matchups", "game_id"): ("games", "game_id"),
    ("player_matchups", "team_id"): ("teams", "team_id"),
    ("player_matchups", "off_player_id"): ("players", "player_id"),
    ("player_matchups", "def_player_id"): ("players", "player_id"),
}

# --- Fixed values: payload column names, in order of preference --------------------

ALIASES = {
    "game_id": ["gameId", "GAME_ID"],
    "team_id": ["teamId", "TEAM_ID", "offensiveTeamId"],
    "player_id": ["personId", "PLAYER_ID", "person_id", "PERSON_ID"],
    "minutes": ["minutes", "MIN"],
    "pts": ["points", "PTS"],
    "reb": ["reboundsTotal", "REB"],
    "ast": ["assists", "AST"],
    "stl": ["steals", "STL"],
    "blk": ["blocks", "BLK"],
    "tov": ["turnovers", "TOV"],
    "pf": ["foulsPersonal", "PF"],
    "plus_minus": ["plusMinusPoints", "PLUS_MINUS"],
    "fgm": ["fieldGoalsMade", "FGM"],
    "fga": ["fieldGoalsAttempted", "FGA"],
    "fg_pct": ["fieldGoalsPercentage", "FG_PCT"],
    "fg3m": ["threePointersMade", "FG3M"],
    "fg3a": ["threePointersAttempted", "FG3A"],
    "fg3_pct": ["threePointersPercentage", "FG3_PCT"],
    "ftm": ["freeThrowsMade", "FTM"],
    "fta": ["freeThrowsAttempted", "FTA"],
    "ft_pct": ["freeThrowsPercentage", "FT_PCT"],
    "off_rating": ["offensiveRating"],
    "def_rating": ["defensiveRating"],
    "net_rating": ["netRating"],
    "usg_pct": ["usagePercentage"],
    "pace": ["pace"],
    "pie": ["PIE"],
    "off_player_id": ["personIdOff", "offensivePlayerId"],
    "def_player_id": ["personIdDef", "defensivePlayerId"],
    "matchup_minutes": ["matchupMinutes"],
    "points_allowed": ["playerPoints", "playerPts"],
    "matchup_ast": ["matchupAssists"],
    "matchup_tov": ["matchupTurnovers"],
    "matchup_blk": ["matchupBlocks"],
    "screen_assists": ["SCREEN_ASSISTS"],
    "deflections": ["DEFLECTIONS"],
    "loose_balls_recovered": ["LOOSE_BALLS_RECOVERED"],
    "charges_drawn": ["CHARGES_DRAWN"],
    "contested_shots": ["CONTESTED_SHOTS"],
    "box_outs": ["BOX_OUTS"],
    "event_num": ["actionNumber", "EVENTNUM"],
    "period": ["period", "PERIOD"],
    "clock": ["clock", "PCTIMESTRING"],
    "action_type": ["actionType", "EVENTMSGTYPE"],
    "sub_type": ["subType", "EVENTMSGACTIONTYPE"],
    "description": ["description", "HOMEDESCRIPTION", "VISITORDESCRIPTION"],
    "shot_result": ["shotResult"],
    "loc_x": ["xLegacy", "LOC_X"],
    "loc_y": ["yLegacy", "LOC_Y"],
    "margin": ["pointsTotal", "SCOREMARGIN"],
    "score_home": ["scoreHome"],
    "score_away": ["scoreAway"],
    "in_time_real": ["IN_TIME_REAL"],
    "out_time_real": ["OUT_TIME_REAL"],
    "pt_diff": ["PT_DIFF"],
    "dist_miles": ["DIST_MILES"],
    "avg_speed": ["AVG_SPEED"],
    "avg_speed_off": ["AVG_SPEED_OFF"],
    "avg_speed_def": ["AVG_SPEED_DEF"],
}

LINE_SCORE_NAMES = {
    "gameId": "GAME_ID",
    "teamId": "TEAM_ID",
    "teamTricode": "TEAM_ABBREVIATION",
    "period1Score": "PTS_QTR1",
    "period2Score": "PTS_QTR2",
    "period3Score": "PTS_QTR3",
    "period4Score": "PTS_QTR4",
    "score": "PTS",
}
#: Overtimes a source tells apart, and the names of their points where periods are numbered on.
MAX_OVERTIMES = 10
OVERTIME_NAMES = {f"period{4 + i}Score": f"PTS_OT{i}" for i in range(1, MAX_OVERTIMES + 1)}

SEASON_TYPES = {"1": "preseason", "2": "regular", "4": "playoffs", "5": "playin"}

BEST_FIT_DDL = (
    "Team STRING, Games LONG, MSE_D1 DOUBLE, MSE_D2 DOUBLE, MSE_D3 DOUBLE, Best_Degree INT"
)

# Right-closed bins of the lead after the third quarter.
SITUATION_EDGES = [-100, -15, -6, 6, 15, 100]
SITUATION_LABELS = ["Big Deficit", "Mod Deficit", "Close Game", "Mod Lead", "Big Lead"]

# -----------------------------------------------------------------------------------


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLE_DDL[name])


def line_score_schema(overtimes: int) -> StructType:
    """The line-score table with the given number of overtime columns."""
    late = {f"PTS_OT{i}" for i in range(overtimes + 1, MAX_OVERTIMES + 1)}
    return StructType([f for f in table_schema("line_scores").fields if f.name not in late])


def registry() -> dict[str, StructType]:
    """Every declared table with its schema."""
    return {name: table_schema(name) for name in TABLE_DDL}
