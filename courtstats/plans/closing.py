"""Closing analyses: how the lead after the third quarter turns into the final margin."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.functions.columns import cut, margin, numeric, sign_flag
from courtstats.operators import fit
from courtstats.operators.aggregates import exact_median, pivot_mean, value_counts
from courtstats.operators.joins import star_join
from courtstats.operators.ordering import best_and_worst, sort_by
from courtstats.operators.sets import stack_sides
from courtstats.operators.windows import forward_fill
from courtstats.schemas import SITUATION_EDGES, SITUATION_LABELS

X, Y, TEAM = "Q3_Lead", "Final_Result", "Team"
# What tells two closing points apart, also the key that assigns folds.
POINT_KEY = ("game_id", "Side")
SCORES = ("score_home", "score_away")


def period_end_scores(
    events: DataFrame,
    keys: Sequence[str] = ("game_id",),
    scores: Sequence[str] = SCORES,
    period: str = "period",
    order: str = "event_num",
    lead_period: int = 3,
    final_period: int | None = 4,
    blank: str = "drop",
    errors: str = "null",
) -> DataFrame:
    """One row per game with the scores at two period ends: q3_h, q3_a, f_h, f_a.

    Both ends come from one scan and one hash aggregate, combined in the scan
    tasks. ``final_period=None`` takes the last period a game reached, so overtime
    counts. A blank score in the last row drops the game, unless ``blank="carry"``
    fills it from the game's earlier rows. Games lacking either end are left out.
    """
    home, away = scores
    if blank not in ("drop", "carry"):
        raise ValueError(f"unknown blank rule {blank!r}")
    numbers = events.select(
        *keys,
        F.col(period).alias("__p"),
        F.col(order).alias("__o"),
        numeric(events, home, errors).alias("__h"),
        numeric(events, away, errors).alias("__a"),
    )
    if blank == "carry":
        numbers = forward_fill(numbers, ["__h", "__a"], keys, "__o")
    p, o = F.col("__p"), F.col("__o")
    if final_period is None:
        # The last event of the last period: order by period first.
        kept = numbers.where(p >= lead_period)
        last = F.struct(p, o)
    else:
        kept = numbers.where(p.isin(lead_period, final_period))
        last = F.when(p == final_period, o)
    lead = F.when(p == lead_period, o)
    ends = kept.groupBy(*keys).agg(
        F.max_by("__h", lead).alias("q3_h"),
        F.max_by("__a", lead).alias("q3_a"),
        F.max_by("__h", last).alias("f_h"),
        F.max_by("__a", last).alias("f_a"),
    )
    return ends.dropna(subset=["q3_h", "q3_a", "f_h", "f_a"])


def closing_points(
    games: DataFrame, home: str = "home_team", away: str = "away_team", keep: Sequence[str] = ()
) -> DataFrame:
    """Team rows (Team, Side, Q3_Lead, Final_Result) from one row per game, both sides."""
    margins = games.select(
        *keep,
        home,
        away,
        margin(F.col("q3_h"), F.col("q3_a")).alias("__q3"),
        margin(F.col("f_h"), F.col("f_a")).alias("__final"),
    )
    return stack_sides(margins, home, away, {"__q3": X, "__final": Y}, keep, TEAM, "Side")


def closing_games(
    games: DataFrame,
    play_by_play: DataFrame,
    teams: DataFrame,
    season_ids: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Closing points (game_id, Team, Side, Q3_Lead, Final_Result) from the silver tables.

    Events shrink to one row per game before they meet the games. With seasons given, events of
    other games are left out before they are aggregated: by the partition if the event
    table is stored by season (:func:`builds.with_season`), and by a semi-join on the games in any case.
    """
    if season_ids is not None:
        games = games.where(F.col("season_id").isin(*season_ids))
        if "season_id" in play_by_play.columns:
            play_by_play = play_by_play.where(F.col("season_id").isin(*season_ids))
        play_by_play = play_by_play.join(games.select("game_id"), "game_id", "left_semi")
    ends = period_end_scores(play_by_play, **options)
    joined = games.select("game_id", "home_team_id", "away_team_id").join(ends, "game_id")
    named = star_join(
        joined,
        [
            ("home_team_id", teams, "team_id", {"abbreviation": "home_team"}),
            ("away_team_id", teams, "team_id", {"abbreviation": "away_team"}),
        ],
    )
    return closing_points(named, keep=["game_id"])


def closer_ranking(points: DataFrame, x: str = X, y: str = Y, team: str = TEAM) -> DataFrame:
    """Mean points gained against a league-wide linear expectation, per team."""
    return fit.residual_means(points, x, y, 1, [team]).select(
        team, "n", F.col("mean_residual").alias("points_gained")
    )


def closers(points: DataFrame, k: int = 5, x: str = X, y: str = Y, team: str = TEAM) -> DataFrame:
    """The k best and the k worst closers."""
    return best_and_worst(closer_ranking(points, x, y, team), "points_gained", team, k)


def situational_means(
    points: DataFrame,
    degree: int = 3,
    edges: Sequence[float] = SITUATION_EDGES,
    labels: Sequence[str] = SITUATION_LABELS,
    x: str = X,
    y: str = Y,
    team: str = TEAM,
) -> DataFrame:
    """Mean residual per team and situation; leads outside all bins count for the fit only."""
    binned = points.withColumn("Situation", cut(F.col(x), edges, labels))
    return fit.residual_means(binned, x, y, degree, [team, "Situation"])


def situational_matrix(
    points: DataFrame,
    degree: int = 3,
    edges: Sequence[float] = SITUATION_EDGES,
    labels: Sequence[str] = SITUATION_LABELS,
    fill: float | None = None,
    x: str = X,
    y: str = Y,
    team: str = TEAM,
) -> DataFrame:
    """Teams by situations; a situation a team never met is NULL, or ``fill``."""
    means = situational_means(points, degree, edges, labels, x, y, team)
    return pivot_mean(means, team, "Situation", "mean_residual", labels, fill)


def sorted_matrix(matrix: DataFrame, label: str, team: str = TEAM) -> DataFrame:
    return sort_by(matrix, label, team)


def team_shapes(
    points: DataFrame,
    degree: int = 3,
    low: float = -25.0,
    high: float = 25.0,
    grid: int = 100,
    more_than: int = 4,
    x: str = X,
    y: str = Y,
    team: str = TEAM,
) -> DataFrame:
    """Fitted curve of each team with enough rows, beside the league's on the same grid."""
    return shapes_of(fit.moment_sums(points, x, y, degree, [team], []), degree, low, high, grid, more_than, team)


def shapes_of(
    sums: DataFrame, degree: int, low: float, high: float, grid: int, more_than: int, team: str = TEAM
) -> DataFrame:
    """:func:`team_shapes` from power sums per team that share a centre."""
    league = fit.solve_sums(fit.roll_up(sums, degree), degree).select("coef")
    teams = fit.solve_sums(sums, degree, [team]).where(F.col("n") > more_than)
    both = teams.withColumn("league", league.scalar())
    at = F.explode(fit.linspace(low, high, grid)).alias("x")
    grid_rows = both.where(F.col("coef").isNotNull()).select(team, "coef", "league", at)
    return grid_rows.select(
        team,
        "x",
        fit.horner("coef", "x", degree).alias("y_team"),
        fit.horner("league", "x", degree).alias("y_league"),
    )


def outcome_flags(points: DataFrame, y: str = Y) -> DataFrame:
    """Each team row with its outcome class (the colour of a scatter dot)."""
    return points.withColumn("outcome", sign_flag(F.col(y)))


def team_best_fits(
    points: DataFrame,
    key: Sequence[str] = POINT_KEY,
    degrees: Sequence[int] = (1, 2, 3),
    k: int = 5,
    min_rows: int = 10,
    x: str = X,
    y: str = Y,
    team: str = TEAM,
) -> DataFrame:
    """Cross-validated MSE per degree and the best degree, per team with enough rows."""
    scores = fit.poly_cv_by(points, x, y, [team], degrees, k, key, min_rows)
    usable = F.when(F.col("mse").isNotNull(), F.struct("mse", "degree"))
    return scores.groupBy(team).agg(
        F.first("n").alias("Games"),
        *[F.max(F.when(F.col("degree") == d, F.col("mse"))).alias(f"MSE_D{d}") for d in degrees],
        F.min_by("degree", usable).alias("Best_Degree"),
    )


def degree_distribution(best_fits: DataFrame) -> DataFrame:
    return value_counts(best_fits, "Best_Degree", "teams")


def complex_teams(best_fits: DataFrame, team: str = TEAM) -> DataFrame:
    """Teams whose best degree is above 1."""
    return best_fits.where(F.col("Best_Degree") > 1).select(team, "Best_Degree")


def degree_tuning(
    points: DataFrame,
    key: Sequence[str] = POINT_KEY,
    degrees: Sequence[int] = (1, 2, 3, 4, 5),
    k: int = 5,
    x: str = X,
    y: str = Y,
) -> DataFrame:
    """Cross-validated MSE and R2 of each degree over the league, the winner marked."""
    scores = fit.poly_cv(points, x, y, degrees, k, key)
    winner = fit.best_degree(scores).select("degree").scalar()
    return scores.withColumn("best", F.col("degree") == winner)


def tuning_curves(
    points: DataFrame,
    degrees: Sequence[int] = (1, 2, 3, 4, 5),
    low: float = -45.0,
    high: float = 45.0,
    grid: int = 100,
    x: str = X,
    y: str = Y,
) -> DataFrame:
    """Curve of every degree, refitted on all rows."""
    fits = fit.refit_all_degrees(points, x, y, degrees)
    return fit.curve_points(fits, low, high, grid, ["degree"])


def sigmoid_start(points: DataFrame, x: str = X, y: str = Y) -> list[float]:
    """First guess for the sigmoid: range of y, median of x, 0.1, minimum of y."""
    return _start_of(fit.collapse(points, x, y))


def _start_of(collapsed: DataFrame) -> list[float]:
    low, high = collapsed.agg(F.min("low"), F.max("high")).first()
    if low is None:
        return [0.0, 0.0, 0.1, 0.0]
    middle = exact_median(collapsed, "x", weight="n").first()[0]
    return [float(high - low), float(middle), 0.1, float(low)]


def closing_sigmoid(points: DataFrame, x: str = X, y: str = Y) -> DataFrame:
    """Sigmoid fit with its own first guess; the points are read once."""
    with _collapsed(points, x, y) as rows:
        return fit.sigmoid_fit_collapsed(rows, _start_of(rows))


@contextmanager
def _collapsed(points: DataFrame, x: str, y: str):
    """One row per distinct lead, kept while several fits read it."""
    rows = fit.collapse(points, x, y).persist()
    try:
        yield rows
    finally:
        rows.unpersist()


_MODELS = {1: "Linear", 3: "Polynomial"}


def model_comparison(points: DataFrame, x: str = X, y: str = Y) -> DataFrame:
    """R2 of the linear, cubic and sigmoid models and the winner, from one pass over the points."""
    with _collapsed(points, x, y) as collapsed:
        closed = fit.refit_collapsed(collapsed, list(_MODELS)).select("degree", "r2").collect()
        sig = fit.sigmoid_fit_collapsed(collapsed, _start_of(collapsed)).first()
    order = {"Linear": 1, "Polynomial": 2, "Sigmoid": 3}
    rows = [(_MODELS[r["degree"]], order[_MODELS[r["degree"]]], r["r2"]) for r in closed]
    if sig["converged"]:
        rows.append(("Sigmoid", 3, sig["r2"]))
    scores = points.sparkSession.createDataFrame(rows, "model string, place int, r2 double")
    winner = fit.best_model(scores, "model", "r2", "place").select("model").scalar()
    return scores.withColumn("winner", F.col("model") == winner)


def comparison_curves(points: DataFrame, grid: int = 200, x: str = X, y: str = Y) -> DataFrame:
    """Linear, cubic and sigmoid curves over the observed range of x; no points, no curves."""
    spark = points.sparkSession
    with _collapsed(points, x, y) as collapsed:
        low, high = collapsed.agg(F.min("x"), F.max("x")).first()
        polys = fit.refit_collapsed(collapsed, list(_MODELS)).select("degree", "coef").collect()
        sig = fit.sigmoid_fit_collapsed(collapsed, _start_of(collapsed))
    fits = spark.createDataFrame(
        [(_MODELS[r["degree"]], r["coef"]) for r in polys], "model string, coef array<double>"
    )
    low, high = (low, high) if low is not None else (0.0, 0.0)
    curves = fit.curve_points(fits, float(low), float(high), grid, ["model"])
    xs = sig.where("converged").select(F.explode(fit.linspace(float(low), float(high), grid)).alias("x"))
    drawn = fit.sigmoid_values(xs, "x", sig, "y").select(F.lit("Sigmoid").alias("model"), "x", "y")
    return curves.unionByName(drawn)
