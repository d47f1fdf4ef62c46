"""Builds: landed payloads to declared tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtstats.functions.columns import parse_minutes
from courtstats.operators.joins import merge_facets, pair_sides
from courtstats.operators.projection import (
    conform,
    drop_nulls,
    filter_not_null,
    project,
    rename,
    split_by_marker,
)
from courtstats.operators.sets import union_all
from courtstats.operators.windows import dedupe
from courtstats.schemas import (
    ALIASES,
    LINE_SCORE_NAMES,
    MAX_OVERTIMES,
    OVERTIME_NAMES,
    line_score_schema,
    table_schema,
)


def build_games(logs: Sequence[DataFrame]) -> DataFrame:
    """Two log rows per game to one game row, over all season types.

    A home row without its away row (or the reverse) forms no game.
    """
    finished = filter_not_null(union_all(list(logs)), "WL")
    home, away = split_by_marker(finished, "MATCHUP")
    paired = pair_sides(home, away, "GAME_ID", ["TEAM_ID", "PTS"])
    return paired.select(
        F.col("GAME_ID").cast("string").alias("game_id"),
        F.to_date("GAME_DATE").alias("game_date"),
        F.col("SEASON_ID").cast("string").alias("season_id"),
        F.col("MATCHUP").alias("matchup"),
        F.col("TEAM_ID_home").cast("long").alias("home_team_id"),
        F.col("TEAM_ID_away").cast("long").alias("away_team_id"),
        F.col("PTS_home").cast("int").alias("home_pts"),
        F.col("PTS_away").cast("int").alias("away_pts"),
    )


def build_box_score(traditional: DataFrame, advanced: DataFrame, misc: DataFrame) -> DataFrame:
    """Three box-score facets joined per game, player and team, then conformed."""
    merged = merge_facets([traditional, advanced, misc], ["gameId", "personId", "teamId"])
    return conform(merged, table_schema("player_game_stats"), ALIASES)


def build_play_by_play(payload: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Conformed events, the first row per (game, event number).

    ``order`` names payload columns that state which duplicate came first; they
    must not collide with a table column.
    """
    schema = table_schema("play_by_play")
    keys = ["game_id", "event_num"]
    if not order:
        # Without a stated order the duplicates are told apart by their content.
        base = conform(payload, schema, ALIASES)
        return dedupe(base, keys, [c for c in base.columns if c not in keys])
    rows, names = _conform_ordered(payload, "play_by_play", order)
    return dedupe(rows, keys, names).drop(*names)


def _conform_ordered(payload: DataFrame, table: str, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Conformed rows that still carry the payload columns that order duplicates, and their names."""
    schema = table_schema(table)
    for c in order:
        schema = schema.add(f"__order_{c}", payload.schema[c].dataType)
    wide = payload.withColumns({f"__order_{c}": F.col(c) for c in order})
    return conform(wide, schema, ALIASES), [f"__order_{c}" for c in order]


def with_season(rows: DataFrame, games: DataFrame) -> DataFrame:
    """Adds the season of the game: the column to store a large table by. Rows of unknown games have none."""
    seasons = games.select("game_id", "season_id")
    return rows.join(seasons, "game_id", "left")


def build_hustle(payload: DataFrame) -> DataFrame:
    return conform(payload, table_schema("hustle_stats"), ALIASES)


def build_matchups(payload: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Conformed matchups: null players dropped, minutes parsed, one row per pair.

    Minutes arrive as ``m:ss`` text; the payload's numeric minutes serve where the
    text does not parse. Of duplicate pairs the first by the payload columns ``order`` stays,
    or the longest matchup if none is given.
    """
    fallback = F.col("matchupMinutesSort") if "matchupMinutesSort" in payload.columns else None
    if "matchupMinutes" in payload.columns:
        payload = payload.withColumn(
            "matchupMinutes", parse_minutes(F.col("matchupMinutes").cast("string"), fallback)
        )
    keys = ["game_id", "off_player_id", "def_player_id"]
    if order:
        rows, names = _conform_ordered(payload, "player_matchups", order)
        return dedupe(drop_nulls(rows, keys[1:]), keys, names).drop(*names)
    rows = conform(payload, table_schema("player_matchups"), ALIASES)
    rows = drop_nulls(rows, keys[1:])
    rest = [F.col(c) for c in rows.columns if c not in (*keys, "matchup_minutes")]
    return dedupe(rows, keys, [F.col("matchup_minutes").desc_nulls_last(), *rest])


def build_rotations(result_sets: Sequence[DataFrame]) -> DataFrame:
    """Shifts of both teams, with a number within the game that a reload reproduces.

    Key of a shift: (game_id, row_id).
    """
    rows = conform(union_all(list(result_sets)), table_schema("game_rotations"), ALIASES)
    # Numbered within the game: equal shifts get numbers of their own, and no two games can collide.
    shift = Window.partitionBy("game_id").orderBy("team_id", "player_id", "in_time_real", "out_time_real", "pt_diff")
    return rows.withColumn("row_id", F.row_number().over(shift).cast("long"))


def line_scores_long(payloads: Sequence[DataFrame]) -> DataFrame:
    """One row per game, team and period that a payload of either shape holds.

    Quarters are periods 1 to 4, overtimes go on from 5. A missing overtime has no row, a missing
    quarter has null points. The team's total (``total``) and the other columns stay beside every period.
    """
    names = {**LINE_SCORE_NAMES, **OVERTIME_NAMES}
    period = {f"PTS_QTR{i}": i for i in range(1, 5)} | {f"PTS_OT{i}": 4 + i for i in range(1, MAX_OVERTIMES + 1)}
    keep = ["GAME_DATE_EST", "GAME_ID", "TEAM_ID", "TEAM_ABBREVIATION", "PTS"]
    out = {k: "total" if k == "PTS" else k for k in keep}
    frames = []
    for payload in payloads:
        named = rename(payload, {k: v for k, v in names.items() if k in payload.columns})
        cells = [
            F.struct(F.lit(nr).alias("period"), F.col(c).cast("int").alias("pts"))
            for c, nr in period.items()
            if c in named.columns
        ]
        declared = table_schema("line_scores")
        kept = [(F.col(k) if k in named.columns else F.lit(None)).cast(declared[k].dataType).alias(out[k]) for k in keep]
        frames.append(named.select(*kept, F.explode(F.array(*cells)).alias("cell")))
    long = union_all(frames).select(*out.values(), "cell.period", "cell.pts")
    return long.where((F.col("period") <= 4) | F.col("pts").isNotNull())


def build_line_scores(payloads: Sequence[DataFrame], overtimes: int = MAX_OVERTIMES) -> DataFrame:
    """Wide line scores pivoted from the long ones; missing overtime points are 0.

    A game with more overtimes than asked for isn't cut: its row fails the build.
    """
    keys = ["GAME_DATE_EST", "GAME_ID", "TEAM_ID", "TEAM_ABBREVIATION"]
    long = line_scores_long(payloads)

    def points(nr: int):
        return F.max(F.when(F.col("period") == nr, F.col("pts")))

    beyond = F.max(F.when(F.col("pts") != 0, F.col("period"))) > 4 + overtimes
    wide = long.groupBy(*keys, F.col("total").alias("PTS")).agg(
        *[points(i).alias(f"PTS_QTR{i}") for i in range(1, 5)],
        *[F.coalesce(points(4 + i), F.lit(0)).alias(f"PTS_OT{i}") for i in range(1, overtimes + 1)],
        beyond.alias("__beyond"),
    )
    checked = wide.withColumn(
        "PTS_QTR1",
        F.when(F.col("__beyond"), F.raise_error("a game has more overtimes than columns").cast("int")).otherwise(
            F.col("PTS_QTR1")
        ),
    )
    return conform(checked.drop("__beyond"), line_score_schema(overtimes), {})


def build_teams(records: DataFrame) -> DataFrame:
    """Team records to the declared table; the full name serves as nickname."""
    picked = project(
        records, ["id", "abbreviation", "full_name", "city", "state", "year_founded"]
    )
    named = rename(picked, {"id": "team_id", "full_name": "nickname"})
    return conform(named, table_schema("teams"), {})


def build_players(records: DataFrame) -> DataFrame:
    picked = project(records, ["id", "full_name", "first_name", "last_name", "is_active"])
    return conform(rename(picked, {"id": "player_id"}), table_schema("players"), {})
