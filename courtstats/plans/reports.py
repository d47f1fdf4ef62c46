"""Reports: defender matchups, scoreboard, load plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.functions.columns import format_number
from courtstats.operators.aggregates import pair_by_key
from courtstats.operators.joins import defender_names, matchup_sides, missing_keys, one_player
from courtstats.operators.ordering import top_k
from courtstats.operators.projection import filter_not_null
from courtstats.operators.quality import completeness, load_status
from courtstats.operators.sets import union_all


def defender_totals(joined: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Totals per defender from :func:`matchup_sides` rows, named at the end.

    Defenders are told apart by id, so namesakes stay separate; a defender who
    changed teams shows the team of the latest game.
    """
    # Numbers only until one row per defender is left: hash aggregates without sorts. Per game
    # first, which makes the distinct count a plain count.
    per_game = joined.groupBy("def_player_id", "game_id").agg(
        F.max("def_team_id").alias("team_id"),
        F.sum("matchup_minutes").alias("mins"),
        F.sum("points_allowed").alias("pts"),
        F.sum("matchup_ast").alias("ast"),
        F.sum("matchup_tov").alias("tov"),
    )
    totals = per_game.groupBy("def_player_id").agg(
        F.max_by("team_id", "game_id").alias("def_team_id"),
        F.count(F.lit(1)).alias("games_faced"),
        F.sum("mins").alias("mins_guarded"),
        F.sum("pts").alias("pts_scored"),
        F.sum("ast").alias("ast_allowed"),
        F.sum("tov").alias("tov_forced"),
    )
    named = defender_names(totals, players, teams)
    counts = ["games_faced", "mins_guarded", "pts_scored", "ast_allowed", "tov_forced"]
    return named.select("def_player_id", "defender", "team", *counts)


def nemesis_report(
    matchups: DataFrame,
    players: DataFrame,
    box_scores: DataFrame,
    teams: DataFrame,
    attacker: str | int,
    k: int = 10,
) -> DataFrame:
    """The k opponents who guarded a player longest, with minutes as one-decimal text.

    ``attacker`` is an id, or a full name that one player only bears.
    """
    chosen = one_player(players, attacker)
    totals = defender_totals(matchup_sides(matchups, box_scores, chosen), players, teams)
    first = top_k(totals, [F.col("mins_guarded").desc_nulls_last(), F.col("def_player_id")], k)
    return first.withColumn("mins_guarded", format_number(F.col("mins_guarded"), 1))


def scoreboard(log: DataFrame, k: int = 10) -> DataFrame:
    """The last k games of a log, each with its rows bundled; a game short of a row is marked incomplete."""
    rows = log.select("GAME_ID", "GAME_DATE", "MATCHUP", "PTS")
    last = top_k(rows.select("GAME_ID").distinct(), [F.col("GAME_ID").desc()], k)
    latest = rows.join(last, "GAME_ID", "left_semi")
    return pair_by_key(latest, "GAME_ID", "MATCHUP", ["GAME_DATE", "MATCHUP", "PTS"])


def incomplete_games(log: DataFrame) -> DataFrame:
    return completeness(log, "GAME_ID", 2)


def completed_games(logs: Sequence[DataFrame]) -> DataFrame:
    """Distinct ids of finished games over all season types."""
    return filter_not_null(union_all(list(logs)), "WL").select("GAME_ID").distinct()


def missing_dates(games: DataFrame, line_scores: DataFrame) -> DataFrame:
    """Dates of games without any line score, ascending, with the games of the date."""
    dates = games.where(F.col("game_date").isNotNull()).groupBy("game_date").agg(F.count(F.lit(1)).alias("games"))
    known = line_scores.select(F.to_date(F.substring("GAME_DATE_EST", 1, 10)).alias("game_date"))
    return dates.join(known, "game_date", "left_anti").orderBy("game_date")


def load_plan(logs: Sequence[DataFrame], done: DataFrame) -> DataFrame:
    """Finished games that are not loaded yet, ascending."""
    target = completed_games(logs)
    loaded = done.select(F.col("game_id").alias("GAME_ID"))
    return missing_keys(target, loaded, ["GAME_ID"]).orderBy("GAME_ID")


def load_plan_status(logs: Sequence[DataFrame], done: DataFrame) -> DataFrame:
    """Totals of the load plan: target, done, to do."""
    loaded = done.select(F.col("game_id").alias("GAME_ID"))
    return load_status(completed_games(logs), loaded, ["GAME_ID"])
