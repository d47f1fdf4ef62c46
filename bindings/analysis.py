"""Closing analyses, regression and clustering on the event binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import (
    ENDS_CTE,
    EVENTS_CTE,
    ORACLES,
    POINTS_CTE,
    events,
    game_rows,
    horner_sql,
    in_folders,
    ladder_ctes,
    points,
    query,
    r,
    sql_round,
    table,
    with_teams,
)
from courtstats.functions.columns import cut, rounded
from courtstats.operators import fit
from courtstats.operators.aggregates import argmax_by, exact_median, member_lists, members, pivot_mean
from courtstats.operators.cluster import cluster_complexity, cluster_profile, kmeans, kmeans_steps, standardize
from courtstats.plans import archetypes, closing
from courtstats.plans.maintained import MaintainedClosing
from courtstats.session import materialize

X, Y, TEAM = closing.X, closing.Y, closing.TEAM

# Event scores reach 490, so the outer bins are wider than those of real leads.
EDGES = [-1000, -15, -6, 6, 15, 1000]
LABELS = ["Big Deficit", "Mod Deficit", "Close Game", "Mod Lead", "Big Lead"]

SITUATION_SQL = (
    "CASE WHEN x > -1000 AND x <= -15 THEN 'Big Deficit' WHEN x > -15 AND x <= -6 THEN 'Mod Deficit' "
    "WHEN x > -6 AND x <= 6 THEN 'Close Game' WHEN x > 6 AND x <= 15 THEN 'Mod Lead' "
    "WHEN x > 15 AND x <= 1000 THEN 'Big Lead' END"
)


def _matrix_sql(degree: int) -> str:
    return f"""{POINTS_CTE}, {ladder_ctes('pts', 'league', degree)},
res AS (SELECT team, {SITUATION_SQL} AS situation, y - {horner_sql(degree, 'league')} AS v
        FROM pts CROSS JOIN league)"""


# --- Closing tables --------------------------------------------------------------------


@query(
    "period_end_scores",
    f"WITH {ENDS_CTE} SELECT game_id, q3_h, q3_a, f_h, f_a FROM game",
)
def _period_end_scores(spark, sf):
    return game_rows(spark, sf).select("game_id", "q3_h", "q3_a", "f_h", "f_a")


@query(
    "closing_points",
    f'WITH {POINTS_CTE} SELECT game_id, team AS "Team", {sql_round("x")} AS "Q3_Lead", '
    f'{sql_round("y")} AS "Final_Result" FROM pts',
)
def _closing_points(spark, sf):
    return points(spark, sf).select("game_id", TEAM, r(X), r(Y))


def _silver(spark, sf):
    """Games, play-by-play and teams in their declared shape."""
    plays = events(spark, sf).select(
        F.col("game_id").cast("string").alias("game_id"),
        "event_num",
        "period",
        F.col("score_home").cast("string").alias("score_home"),
        "score_away",
        "user_id",
        "week",
    )
    named = with_teams(plays.select("game_id", "user_id", "week").distinct(), spark, sf)
    # The first four weeks are the regular season, later ones the playoffs.
    season = F.when(F.col("week") <= 4, "22024").otherwise("42024")
    teams = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("abbreviation")
    )
    home = teams.select(F.col("team_id").alias("home_team_id"), F.col("abbreviation").alias("home_team"))
    away = teams.select(F.col("team_id").alias("away_team_id"), F.col("abbreviation").alias("away_team"))
    games = (
        named.withColumn("season_id", season)
        .join(home, "home_team")
        .join(away, "away_team")
        .select("game_id", "season_id", "home_team_id", "away_team_id")
    )
    return games, plays.drop("user_id", "week"), teams


@query(
    "closing_games",
    f'WITH {POINTS_CTE} SELECT CAST(game_id AS VARCHAR) AS game_id, team AS "Team", '
    f'{sql_round("x")} AS "Q3_Lead", {sql_round("y")} AS "Final_Result" FROM pts WHERE game_id % 100 <= 4',
)
def _closing_games(spark, sf):
    games, plays, teams = _silver(spark, sf)
    return closing.closing_games(games, plays, teams, ["22024"]).select(
        "game_id", TEAM, r(X), r(Y)
    )


@query(
    "closing_games_all_seasons",
    "WITH "
    + POINTS_CTE
    + ' SELECT CAST(game_id AS VARCHAR) AS game_id, team AS "Team", '
    + f'{sql_round("x")} AS "Q3_Lead", {sql_round("y")} AS "Final_Result" FROM pts',
)
def _closing_games_all(spark, sf):
    games, plays, teams = _silver(spark, sf)
    return closing.closing_games(games, plays, teams, errors="raise").select(
        "game_id", TEAM, r(X), r(Y)
    )


@query(
    "closing_last_period",
    f"""WITH {EVENTS_CTE},
q3 AS (SELECT game_id, h, a FROM ev WHERE period = 3
       QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY event_num DESC) = 1),
fin AS (SELECT game_id, h, a FROM ev WHERE period >= 3
        QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY period DESC, event_num DESC) = 1)
SELECT q3.game_id, q3.h AS q3_h, q3.a AS q3_a, fin.h AS f_h, fin.a AS f_a
FROM q3 JOIN fin ON q3.game_id = fin.game_id""",
)
def _closing_last_period(spark, sf):
    return closing.period_end_scores(events(spark, sf), ["game_id"], final_period=None)


BLANK_EVERY = 3  # every third event has no score in the carry and drop queries


def _blanked(spark, sf):
    ev = events(spark, sf)
    keep = F.col("event_num") % BLANK_EVERY != 0
    return ev.withColumns(
        {
            "score_home": F.when(keep, F.col("score_home")),
            "score_away": F.when(keep, F.col("score_away")).otherwise(""),
        }
    )


_BLANK_CTE = EVENTS_CTE + f""",
bl AS (SELECT game_id, period, event_num, CASE WHEN event_num % {BLANK_EVERY} <> 0 THEN h END AS h,
              CASE WHEN event_num % {BLANK_EVERY} <> 0 THEN a END AS a FROM ev)"""

_BLANK_ENDS = """
q3 AS (SELECT game_id, h, a FROM {src} WHERE period = 3
       QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY event_num DESC) = 1),
fin AS (SELECT game_id, h, a FROM {src} WHERE period = 4
        QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY event_num DESC) = 1)
SELECT q3.game_id, q3.h AS q3_h, q3.a AS q3_a, fin.h AS f_h, fin.a AS f_a
FROM q3 JOIN fin ON q3.game_id = fin.game_id
WHERE q3.h IS NOT NULL AND q3.a IS NOT NULL AND fin.h IS NOT NULL AND fin.a IS NOT NULL"""


@query("closing_blank_drop", f"WITH {_BLANK_CTE}, {_BLANK_ENDS.format(src='bl')}")
def _closing_blank_drop(spark, sf):
    return closing.period_end_scores(_blanked(spark, sf), ["game_id"], blank="drop")


@query(
    "closing_blank_carry",
    f"""WITH {_BLANK_CTE},
ff AS (SELECT game_id, period, event_num, last_value(h IGNORE NULLS) OVER w AS h,
              last_value(a IGNORE NULLS) OVER w AS a FROM bl
       WINDOW w AS (PARTITION BY game_id ORDER BY event_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{_BLANK_ENDS.format(src='ff')}""",
)
def _closing_blank_carry(spark, sf):
    return closing.period_end_scores(_blanked(spark, sf), ["game_id"], blank="carry")


@query(
    "argmax_by",
    """SELECT user_id, event_id, value, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def _argmax_by(spark, sf):
    ev = table(spark, sf, "events")
    return argmax_by(ev, ["user_id"], "event_id", ["event_id", "value", "event_type"])


# --- Rankings and matrices -------------------------------------------------------------

_RANKING_CTE = f"""WITH {POINTS_CTE}, {ladder_ctes('pts', 'league', 1)},
rk AS (SELECT team, count(*) AS n, avg(y - {horner_sql(1, 'league')}) AS g
       FROM pts CROSS JOIN league GROUP BY team)"""


@query(
    "closer_ranking",
    f'{_RANKING_CTE} SELECT team AS "Team", n, {sql_round("g")} AS points_gained FROM rk',
)
def closer_ranking(spark, sf):
    return closing.closer_ranking(points(spark, sf)).select(TEAM, "n", r("points_gained"))


@query(
    "best_and_worst_closers",
    f"""{_RANKING_CTE},
b AS (SELECT 'best' AS side, row_number() OVER (ORDER BY g DESC, team ASC) AS place, team, n, g FROM rk),
w AS (SELECT 'worst' AS side, row_number() OVER (ORDER BY g ASC, team DESC) AS place, team, n, g FROM rk)
SELECT side, place, team AS "Team", n, {sql_round("g")} AS points_gained,
       printf('%+.2f', round(g, 2)) AS gained_text
FROM (SELECT * FROM b UNION ALL SELECT * FROM w) WHERE place <= 5""",
)
def _best_and_worst(spark, sf):
    rows = closing.closers(points(spark, sf), 5)
    text = F.format_string("%+.2f", F.round("points_gained", 2)).alias("gained_text")
    return rows.select("side", "place", TEAM, "n", r("points_gained"), text)


def _pivot_sql(fill: str) -> str:
    cells = []
    for label in LABELS:
        mean = sql_round(f"avg(v) FILTER (situation = '{label}')")
        cells.append((f"coalesce({mean}, 0.0)" if fill else mean) + f' AS "{label}"')
    return ", ".join(cells)


@query(
    "situational_matrix",
    f'WITH {_matrix_sql(3)} SELECT team AS "Team", {_pivot_sql("")} FROM res GROUP BY team',
)
def _situational_matrix(spark, sf):
    m = closing.sorted_matrix(
        closing.situational_matrix(points(spark, sf), 3, EDGES, LABELS), "Close Game"
    )
    return m.select(TEAM, *[r(label) for label in LABELS])


@query(
    "situational_matrix_filled",
    f'WITH {_matrix_sql(1)} SELECT team AS "Team", {_pivot_sql("0")} FROM res GROUP BY team',
)
def _situational_matrix_filled(spark, sf):
    m = closing.situational_matrix(points(spark, sf), 1, EDGES, LABELS, fill=0.0)
    return m.select(TEAM, *[r(label) for label in LABELS])


@query(
    "pivot_mean",
    """SELECT l_returnflag, round(avg(l_quantity) FILTER (l_linestatus = 'F'), 4) AS "F",
round(avg(l_quantity) FILTER (l_linestatus = 'O'), 4) AS "O" FROM lineitem GROUP BY l_returnflag""",
)
def _pivot_mean(spark, sf):
    p = pivot_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", ["F", "O"])
    return p.select("l_returnflag", r("F"), r("O"))


@query(
    "situation_bins",
    f"""WITH {POINTS_CTE} SELECT {SITUATION_SQL} AS situation,
CASE WHEN y > 0 THEN 'win' ELSE 'loss' END AS outcome, count(*) AS n FROM pts GROUP BY ALL""",
)
def _situation_bins(spark, sf):
    flagged = closing.outcome_flags(points(spark, sf))
    return (
        flagged.groupBy(cut(F.col(X), EDGES, LABELS).alias("situation"), "outcome")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- Fits ------------------------------------------------------------------------------


@query(
    "linear_fit",
    """SELECT l_returnflag, regr_count(l_extendedprice, l_quantity) AS n,
round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY l_returnflag""",
)
def _linear_fit(spark, sf):
    f = fit.linear_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return f.select("l_returnflag", "n", r("slope"), r("intercept"), r("r2", 6))


def _coef_columns(degree: int):
    return [
        rounded(F.col("coef")[k], 4 + 2 * k).alias(f"c{k}") for k in range(degree + 1)
    ]


def _coef_sql(alias: str, degree: int) -> str:
    return ", ".join(f"{sql_round(f'{alias}.b{k}', 4 + 2 * k)} AS c{k}" for k in range(degree + 1))


@query(
    "poly_fit_league",
    f"WITH {POINTS_CTE}, {ladder_ctes('pts', 'f', 3)} SELECT n, {_coef_sql('f', 3)} FROM f",
)
def _poly_fit_league(spark, sf):
    return fit.poly_fit(points(spark, sf), X, Y, 3).select("n", *_coef_columns(3))


@query(
    "poly_fit_by_team",
    f'WITH {POINTS_CTE}, {ladder_ctes("pts", "f", 3, ["team"])} '
    f'SELECT team AS "Team", n, {_coef_sql("f", 3)} FROM f WHERE n > 4',
)
def _poly_fit_by_team(spark, sf):
    f = fit.poly_fit(points(spark, sf), X, Y, 3, [TEAM]).where("n > 4")
    return f.select(TEAM, "n", *_coef_columns(3))


@query(
    "poly_fit_prices",
    f"""WITH src AS (SELECT l_linestatus AS g, l_quantity - 25 AS x, l_extendedprice / 1000 AS y FROM lineitem),
{ladder_ctes("src", "f", 2, ["g"])}
SELECT g AS l_linestatus, n, round(b0, 6) AS c0, round(b1, 8) AS c1, round(b2, 8) AS c2 FROM f""",
)
def _poly_fit_prices(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 1000)
    f = fit.poly_fit(li, "l_quantity", "y", 2, ["l_linestatus"], center=25.0)
    return f.select(
        "l_linestatus",
        "n",
        *[rounded(F.col("coef")[k], d).alias(f"c{k}") for k, d in ((0, 6), (1, 8), (2, 8))],
    )


@query(
    "residuals",
    f"""WITH {POINTS_CTE}, {ladder_ctes('pts', 'league', 3)}
SELECT game_id, team AS "Team", {sql_round(horner_sql(3, 'league'))} AS expected,
{sql_round('y - ' + horner_sql(3, 'league'))} AS residual FROM pts CROSS JOIN league""",
)
def _residuals(spark, sf):
    p = points(spark, sf)
    rows = fit.with_expected(p, fit.poly_fit(p, X, Y, 3), X, Y, 3)
    return rows.select("game_id", TEAM, r("expected"), r("residual"))


@query(
    "r2_score",
    f"""WITH {POINTS_CTE}, {ladder_ctes('pts', 'league', 3)},
p AS (SELECT y, {horner_sql(3, 'league')} AS e FROM pts CROSS JOIN league)
SELECT round(1 - sum((y - e) * (y - e)) / (var_pop(y) * count(*)), 6) AS r2 FROM p""",
)
def _r2_score(spark, sf):
    p = points(spark, sf)
    rows = fit.with_expected(p, fit.poly_fit(p, X, Y, 3), X, Y, 3)
    return fit.r2_score(rows, Y, "expected").select(r("r2", 6))


@query(
    "refit_all_degrees",
    "WITH "
    + POINTS_CTE
    + "".join(f", {ladder_ctes('pts', f'f{d}', d)}" for d in range(1, 6))
    + "\n"
    + " UNION ALL ".join(
        f"""SELECT {d} AS degree, max(f{d}.n) AS n, round(sum(pow(y - {horner_sql(d, f'f{d}')}, 2)), 2) AS sse,
round(1 - sum(pow(y - {horner_sql(d, f'f{d}')}, 2)) / (var_pop(y) * count(*)), 6) AS r2
FROM pts CROSS JOIN f{d}"""
        for d in range(1, 6)
    ),
)
def _refit_all_degrees(spark, sf):
    f = fit.refit_all_degrees(points(spark, sf), X, Y, [1, 2, 3, 4, 5])
    return f.select("degree", "n", r("sse", 2), r("r2", 6))


def _cv_sql(degrees, by_team: bool) -> str:
    """Cross-validation with predictions on the held-out rows themselves."""
    by = ["team"] if by_team else []
    keys = "team, " if by_team else ""
    parts = []
    for d in degrees:
        parts.append(ladder_ctes("train", f"t{d}", d, [*by, "hold"]))
    using = f"USING ({keys}hold)" if by_team else "USING (hold)"
    held = " UNION ALL ".join(
        f"""SELECT {keys}{d} AS degree, hold, avg(pow(y - {horner_sql(d, f't{d}')}, 2)) AS mse,
1 - sum(pow(y - {horner_sql(d, f't{d}')}, 2)) / (var_pop(y) * count(*)) AS r2
FROM (SELECT *, fold AS hold FROM fp) JOIN t{d} {using} GROUP BY {keys}hold"""
        for d in degrees
    )
    join = "a.team = b.team AND a.fold <> b.fold" if by_team else "a.fold <> b.fold"
    folds = f"SELECT DISTINCT {keys}fold FROM fp"
    b_keys = "b.team, " if by_team else ""
    return f"""train AS (SELECT {b_keys}b.fold AS hold, a.x, a.y FROM fp a JOIN ({folds}) b ON {join}),
{", ".join(parts)},
held AS ({held}),
cv AS (SELECT {keys}degree, count(*) AS folds, avg(mse) AS mse, avg(r2) AS r2 FROM held GROUP BY {keys}degree)"""


_LEAGUE_CV = f"""WITH {POINTS_CTE},
fp AS (SELECT *, CAST(('0x' || substr(md5(game_id || '|' || side), 1, 8)) AS BIGINT) % 5 AS fold FROM pts),
{_cv_sql([1, 2, 3, 4, 5], False)}"""


@query(
    "degree_tuning",
    f"""{_LEAGUE_CV} SELECT degree, (SELECT count(*) FROM pts) AS n, folds, {sql_round('mse', 3)} AS mse,
{sql_round('r2', 6)} AS r2, mse = (SELECT min(mse) FROM cv) AS best FROM cv""",
)
def _degree_tuning(spark, sf):
    t = closing.degree_tuning(points(spark, sf))
    return t.select("degree", "n", "folds", r("mse", 3), r("r2", 6), "best")


@query(
    "degree_tuning_by_game",
    _LEAGUE_CV.replace("game_id || '|' || side", "CAST(game_id AS VARCHAR)")
    + f" SELECT degree, {sql_round('mse', 3)} AS mse, {sql_round('r2', 6)} AS r2 FROM cv",
)
def _degree_tuning_by_game(spark, sf):
    t = closing.degree_tuning(points(spark, sf), key=["game_id"])
    return t.select("degree", r("mse", 3), r("r2", 6))


_TEAM_CV = f"""WITH {POINTS_CTE},
fp AS (SELECT *, (row_number() OVER (PARTITION BY team ORDER BY md5(game_id || '|' || side)) - 1)
         % greatest(2, least(5, (count(*) OVER (PARTITION BY team)) // 2)) AS fold,
         count(*) OVER (PARTITION BY team) AS n FROM pts QUALIFY n >= 10),
{_cv_sql([1, 2, 3], True)},
wide AS (SELECT team, max(mse) FILTER (degree = 1) AS m1, max(mse) FILTER (degree = 2) AS m2,
         max(mse) FILTER (degree = 3) AS m3, arg_min(degree, mse) AS best FROM cv GROUP BY team)"""


@query(
    "team_best_fits",
    f"""{_TEAM_CV} SELECT team AS "Team", (SELECT count(*) FROM pts WHERE pts.team = wide.team) AS "Games",
{sql_round('m1', 3)} AS "MSE_D1", {sql_round('m2', 3)} AS "MSE_D2", {sql_round('m3', 3)} AS "MSE_D3",
best AS "Best_Degree" FROM wide""",
)
def _team_best_fits(spark, sf):
    b = closing.team_best_fits(points(spark, sf))
    return b.select(TEAM, "Games", r("MSE_D1", 3), r("MSE_D2", 3), r("MSE_D3", 3), "Best_Degree")


@query(
    "best_fits_csv",
    f'{_TEAM_CV} SELECT team AS "Team", best AS "Best_Degree" FROM wide',
)
@in_folders
def _best_fits_csv(spark, sf, folder):
    path = folder("best-fits")
    archetypes.save_best_fits(closing.team_best_fits(points(spark, sf)), path)
    return archetypes.read_best_fits(spark, path)


@query(
    "degree_distribution",
    f'{_TEAM_CV} SELECT best AS "Best_Degree", count(*) AS teams FROM wide GROUP BY best',
)
def _degree_distribution(spark, sf):
    return closing.degree_distribution(closing.team_best_fits(points(spark, sf)))


@query(
    "complex_teams",
    f'{_TEAM_CV} SELECT team AS "Team", best AS "Best_Degree" FROM wide WHERE best > 1',
)
def _complex_teams(spark, sf):
    return closing.complex_teams(closing.team_best_fits(points(spark, sf)))


@query(
    "poly_cv_by_team",
    f"""{_TEAM_CV} SELECT team AS "Team", degree, folds, {sql_round('mse', 3)} AS mse,
{sql_round('r2', 5)} AS r2 FROM cv""",
)
def _poly_cv_by_team(spark, sf):
    s = fit.poly_cv_by(points(spark, sf), X, Y, [TEAM], [1, 2, 3], 5, closing.POINT_KEY)
    return s.select(TEAM, "degree", "folds", r("mse", 3), r("r2", 5))


@query(
    "best_degree",
    f"{_LEAGUE_CV} SELECT arg_min(degree, mse) AS degree, {sql_round('min(mse)', 3)} AS mse FROM cv",
)
def _best_degree(spark, sf):
    scores = fit.poly_cv(points(spark, sf), X, Y, [1, 2, 3, 4, 5], 5, closing.POINT_KEY)
    return fit.best_degree(scores).select("degree", r("mse", 3))


@query(
    "team_shapes",
    f"""WITH {POINTS_CTE}, {ladder_ctes('pts', 'league', 3)}, {ladder_ctes('pts', 't', 3, ['team'])},
grid AS (SELECT -25 + i * 50.0 / 99 AS x FROM range(100) g(i))
SELECT t.team AS "Team", round(grid.x, 6) AS x, {sql_round(horner_sql(3, 't', 'grid.x'), 3)} AS y_team,
{sql_round(horner_sql(3, 'league', 'grid.x'), 3)} AS y_league
FROM t CROSS JOIN league CROSS JOIN grid WHERE t.n > 4""",
)
def _team_shapes(spark, sf):
    return closing.team_shapes(points(spark, sf)).select(
        TEAM, r("x", 6), r("y_team", 3), r("y_league", 3)
    )


@query(
    "tuning_curves",
    "WITH "
    + POINTS_CTE
    + "".join(f", {ladder_ctes('pts', f'f{d}', d)}" for d in range(1, 6))
    + ", grid AS (SELECT -45 + i * 90.0 / 99 AS x FROM range(100) g(i))\n"
    + " UNION ALL ".join(
        f"SELECT {d} AS degree, round(grid.x, 6) AS x, {sql_round(horner_sql(d, f'f{d}', 'grid.x'), 3)} AS y "
        f"FROM f{d} CROSS JOIN grid"
        for d in range(1, 6)
    ),
)
def _tuning_curves(spark, sf):
    return closing.tuning_curves(points(spark, sf)).select("degree", r("x", 6), r("y", 3))


@query(
    "value_range",
    f"WITH {POINTS_CTE} SELECT {sql_round('min(y)')} AS lo, {sql_round('max(y)')} AS hi, "
    f"{sql_round('median(x)')} AS mid FROM pts",
)
def _value_range(spark, sf):
    p = points(spark, sf)
    ends = p.agg(rounded(F.min(Y), 4).alias("lo"), rounded(F.max(Y), 4).alias("hi"))
    return ends.withColumn("mid", rounded(exact_median(p, X).scalar(), 4))


@query(
    "exact_median",
    "SELECT round(median(l_extendedprice), 4) AS median_price FROM lineitem",
)
def _exact_median(spark, sf):
    li = table(spark, sf, "lineitem")
    return exact_median(li, "l_extendedprice", "median_price").select(r("median_price", 4))


@query(
    "best_closed_model",
    f"""WITH {POINTS_CTE}, {ladder_ctes('pts', 'f1', 1)}, {ladder_ctes('pts', 'f3', 3)},
s AS (SELECT 'Linear' AS model, 1 AS place, 1 - sum(pow(y - {horner_sql(1, 'f1')}, 2)) / (var_pop(y) * count(*)) AS r2
      FROM pts CROSS JOIN f1
      UNION ALL
      SELECT 'Polynomial', 2, 1 - sum(pow(y - {horner_sql(3, 'f3')}, 2)) / (var_pop(y) * count(*))
      FROM pts CROSS JOIN f3)
SELECT model, round(r2, 6) AS r2 FROM s ORDER BY s.r2 DESC, place LIMIT 1""",
)
def _best_closed_model(spark, sf):
    f = fit.refit_all_degrees(points(spark, sf), X, Y, [1, 3]).withColumn(
        "model", F.when(F.col("degree") == 1, "Linear").otherwise("Polynomial")
    )
    return fit.best_model(f, "model", "r2", "degree").select("model", r("r2", 6))


@query("model_comparison")
def _model_comparison(spark, sf):
    return closing.model_comparison(points(spark, sf)).select("model", r("r2", 6), "winner")


@query("comparison_curves")
def _comparison_curves(spark, sf):
    return closing.comparison_curves(points(spark, sf))


@query("sigmoid_fit")
def _sigmoid_fit(spark, sf):
    return closing.closing_sigmoid(points(spark, sf))


def _known_sigmoid(spark, sf):
    """A point per line: y = 40 / (1 + exp(-0.2 (quantity - 25))) + 3."""
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        q.alias("q"), (F.lit(40.0) / (1 + F.exp(-0.2 * (q - 25))) + 3).alias("v")
    )


@query(
    "sigmoid_fit_known",
    """SELECT count(*) AS n, 40.0::DOUBLE AS height, 25.0::DOUBLE AS x0, 0.2::DOUBLE AS k, 3.0::DOUBLE AS base,
true AS converged FROM lineitem""",
)
def _sigmoid_fit_known(spark, sf):
    found = closing.closing_sigmoid(_known_sigmoid(spark, sf), "q", "v")
    return found.select("n", r("height", 4), r("x0", 4), r("k", 4), r("base", 4), "converged")


_KNOWN = "pts AS (SELECT l_quantity AS x, 40 / (1 + exp(-0.2 * (l_quantity - 25))) + 3 AS y FROM lineitem)"


@query(
    "model_comparison_known",
    f"""WITH {_KNOWN}, {ladder_ctes('pts', 'f1', 1)}, {ladder_ctes('pts', 'f3', 3)}
SELECT 'Linear' AS model, round(1 - sum(pow(y - {horner_sql(1, 'f1')}, 2)) / (var_pop(y) * count(*)), 5) AS r2,
false AS winner FROM pts CROSS JOIN f1
UNION ALL SELECT 'Polynomial', round(1 - sum(pow(y - {horner_sql(3, 'f3')}, 2)) / (var_pop(y) * count(*)), 5), false
FROM pts CROSS JOIN f3
UNION ALL SELECT 'Sigmoid', 1.0, true""",
)
def _model_comparison_known(spark, sf):
    found = closing.model_comparison(_known_sigmoid(spark, sf), "q", "v")
    return found.select("model", r("r2", 5), "winner")


@query(
    "comparison_curves_known",
    f"""WITH {_KNOWN}, {ladder_ctes('pts', 'f1', 1)}, {ladder_ctes('pts', 'f3', 3)},
ends AS (SELECT min(x) AS a, max(x) AS b FROM pts),
grid AS (SELECT a + i * (b - a) / 199 AS x FROM ends CROSS JOIN range(200) g(i))
SELECT 'Linear' AS model, round(grid.x, 6) AS x, round({horner_sql(1, 'f1', 'grid.x')}, 3) AS y FROM grid CROSS JOIN f1
UNION ALL SELECT 'Polynomial', round(grid.x, 6), round({horner_sql(3, 'f3', 'grid.x')}, 3) FROM grid CROSS JOIN f3
UNION ALL SELECT 'Sigmoid', round(x, 6), round(40 / (1 + exp(-0.2 * (x - 25))) + 3, 3) FROM grid""",
)
def _comparison_curves_known(spark, sf):
    found = closing.comparison_curves(_known_sigmoid(spark, sf), x="q", y="v")
    return found.select("model", r("x", 6), r("y", 3))


_FAR = """pts AS (SELECT 1000 + l_quantity * 4 AS x, l_extendedprice / 1000 AS y, l_returnflag AS g,
CAST(l_orderkey % 5 AS INTEGER) AS fold FROM lineitem)"""


def _far_points(spark, sf):
    """x far from zero: quantities times four, from 1,004 to 1,200."""
    return table(spark, sf, "lineitem").select(
        (1000 + F.col("l_quantity") * 4).alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"),
        F.col("l_returnflag").alias("g"),
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
    )


@query(
    "refit_far_from_zero",
    f"""WITH {_FAR}, z AS (SELECT (x - 1100) / 60 AS x, y FROM pts), t AS (SELECT var_pop(y) * count(*) AS sst FROM z)"""
    + "".join(f", {ladder_ctes('z', f'f{d}', d, scale=1.0)}" for d in range(1, 6))
    + " "
    + " UNION ALL ".join(
        f"SELECT {d} AS degree, count(*) AS n, round(1 - sum(pow(y - {horner_sql(d, f'f{d}')}, 2)) / max(sst), 7) AS r2, "
        f"true AS fitted FROM z CROSS JOIN f{d} CROSS JOIN t"
        for d in range(1, 6)
    ),
)
def _refit_far_from_zero(spark, sf):
    f = fit.refit_all_degrees(_far_points(spark, sf), "x", "y", [1, 2, 3, 4, 5])
    return f.select("degree", "n", r("r2", 7), F.col("coef").isNotNull().alias("fitted"))


def _far_fold(d: int, f: int) -> str:
    return ladder_ctes(f"tr{f}", f"c{d}_{f}", d, ["g"], scale=1.0)


@query(
    "cross_validate_far_from_zero",
    f"""WITH {_FAR}, z AS (SELECT (x - 1100) / 60 AS x, y, g, fold FROM pts)"""
    + "".join(f", tr{f} AS (SELECT x, y, g FROM z WHERE fold <> {f})" for f in range(5))
    + "".join(f", {_far_fold(d, f)}" for d in (1, 5) for f in range(5))
    + ", each AS ("
    + " UNION ALL ".join(
        f"SELECT z.g, {d} AS degree, avg(pow(y - {horner_sql(d, 'c')}, 2)) AS mse "
        f"FROM z JOIN c{d}_{f} c ON c.g = z.g WHERE fold = {f} GROUP BY z.g"
        for d in (1, 5)
        for f in range(5)
    )
    + ") SELECT g, degree, count(*) AS folds, round(avg(mse), 3) AS mse FROM each GROUP BY g, degree",
)
def _cross_validate_far_from_zero(spark, sf):
    found = fit.cross_validate(_far_points(spark, sf), "x", "y", [1, 5], ["g"])
    return found.select("g", "degree", "folds", r("mse", 3))


# --- Clusters --------------------------------------------------------------------------


@query(
    "standardize",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS z,
CAST(0.0 AS DOUBLE) AS flat_z FROM customer""",
)
def _standardize(spark, sf):
    c = table(spark, sf, "customer").withColumn("flat", F.lit(7.0))
    return standardize(c, ["c_acctbal", "flat"]).select(
        "c_custkey", r("c_acctbal_z", 6, "z"), r("flat_z", 6)
    )


def _archetypes(spark, sf):
    return archetypes.team_archetypes(points(spark, sf), 5, EDGES, LABELS)


def _steps_sql(k: int, steps: int) -> str:
    """CTEs ``lab(key, c)`` and ``mid(c, f)`` from ``z(key, f)``: the rules of ``kmeans_steps``, a step per CTE."""
    away = "round(list_distance({0}, {1}), 9)"
    out = ["h AS MATERIALIZED (SELECT key, f, md5(CAST(key AS VARCHAR)) AS m FROM z ORDER BY m, f LIMIT 1000)"]
    out.append("e0 AS MATERIALIZED (SELECT 0 AS c, f FROM h ORDER BY m, f LIMIT 1)")
    for j in range(1, k):
        furthest = (
            f"(SELECT {j} AS c, f FROM (SELECT h.f, h.m, min({away.format('h.f', 'e.f')}) AS d FROM h, e{j - 1} e GROUP BY ALL) "
            "WHERE d > 0 ORDER BY d DESC, m, f LIMIT 1)"
        )
        out.append(f"e{j} AS MATERIALIZED (SELECT * FROM e{j - 1} UNION ALL {furthest})")
    out.append(f"s0 AS MATERIALIZED (SELECT * FROM e{k - 1})")

    def nearest(centres: str) -> str:
        return (
            f"SELECT key, any_value(z.f) AS f, arg_min(e.c, {{'d': {away.format('z.f', 'e.f')}, 'c': e.c}}) AS c "
            f"FROM z, {centres} e GROUP BY key"
        )

    for t in range(1, steps + 1):
        cells = f"SELECT c, unnest(f) AS v, generate_subscripts(f, 1) AS i FROM ({nearest(f's{t - 1}')})"
        means = f"SELECT c, i, round(avg(v), 9) + 0.0 AS v FROM ({cells}) GROUP BY c, i"
        new = f"SELECT c, list(v ORDER BY i) AS f FROM ({means}) GROUP BY c"
        out.append(f"s{t} AS MATERIALIZED (SELECT s.c, coalesce(n.f, s.f) AS f FROM s{t - 1} s LEFT JOIN ({new}) n USING (c))")
    out.append(f"mid AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY f) - 1 AS INTEGER) AS c, f FROM s{steps})")
    out.append(f"lab AS MATERIALIZED (SELECT key, c FROM ({nearest('mid')}))")
    return ",\n".join(out)


def _scaled_sql(cols: list[str], source: str) -> str:
    """CTE ``z(key, f)``: the columns of a source with a team, standardised."""
    cells = [
        f'("{c}" - avg("{c}") OVER ()) / CASE WHEN stddev_pop("{c}") OVER () > 0 THEN stddev_pop("{c}") OVER () ELSE 1 END'
        for c in cols
    ]
    return f"z AS MATERIALIZED (SELECT team AS key, [{', '.join(cells)}] AS f FROM {source})"


_FEATURES = ", ".join(f"coalesce(avg(v) FILTER (situation = '{c}'), 0) AS \"{c}\"" for c in LABELS)
_ARCHETYPES_SQL = f"""WITH {_matrix_sql(3)}, m AS MATERIALIZED (SELECT team, {_FEATURES} FROM res GROUP BY team),
{_scaled_sql(LABELS, 'm')}, {_steps_sql(5, 12)}"""


def _archetypes(spark, sf):
    return archetypes.team_archetypes(points(spark, sf), 5, EDGES, LABELS)


def _rounded_sql(cols: list[str]) -> str:
    return ", ".join(f'{sql_round(f"{chr(34)}{c}{chr(34)}")} AS "{c}"' for c in cols)


@query("team_archetypes", f'{_ARCHETYPES_SQL} SELECT team AS "Team", {_rounded_sql(LABELS)}, c AS cluster FROM m JOIN lab ON key = team')
def _team_archetypes(spark, sf):
    return _archetypes(spark, sf).select(TEAM, *[r(c) for c in LABELS], "cluster")


def _profiles_sql(extra: str = "") -> str:
    """Means per cluster with the names of the largest and the smallest."""
    means = ", ".join(f'avg("{c}") AS "{c}"' for c in LABELS)
    values = f"[{', '.join(chr(34) + c + chr(34) for c in LABELS)}]"
    names = "[" + ", ".join(f"'{c}'" for c in LABELS) + "]"
    best = f"{names}[list_position({values}, list_max({values}))] AS best"
    worst = f"{names}[list_position({values}, list_min({values}))] AS worst"
    return f"""SELECT cluster, size, {_rounded_sql(LABELS)}, {best}, {worst}{extra} FROM
(SELECT c AS cluster, count(*) AS size, {means}{', avg(best) AS d' if extra else ''} FROM m JOIN lab ON key = team GROUP BY c)"""


@query("archetype_profiles", f"{_ARCHETYPES_SQL} {_profiles_sql()}")
def _archetype_profiles(spark, sf):
    found = archetypes.archetype_profiles(_archetypes(spark, sf), LABELS)
    return found.select("cluster", "size", *[r(c) for c in LABELS], "best", "worst")


@query(
    "archetype_members",
    f"{_ARCHETYPES_SQL} SELECT c AS cluster, string_agg(key, ', ' ORDER BY key) AS members, count(*) AS size FROM lab GROUP BY c",
)
def _archetype_members(spark, sf):
    return member_lists(_archetypes(spark, sf), "cluster", TEAM)


_ADVANCED_SQL = f"""{_TEAM_CV}, {ladder_ctes('pts', 'league1', 1)},
res1 AS (SELECT team, {SITUATION_SQL} AS situation, y - {horner_sql(1, 'league1')} AS v FROM pts CROSS JOIN league1),
m AS MATERIALIZED (SELECT f.*, best FROM (SELECT team, {_FEATURES} FROM res1 GROUP BY team) f JOIN wide USING (team)
WHERE best IS NOT NULL), {_scaled_sql([*LABELS, 'best'], 'm')}, {_steps_sql(6, 12)}"""


@query(
    "team_archetypes_advanced",
    f"""{_ADVANCED_SQL} SELECT team AS "Team", {_rounded_sql(LABELS)}, best AS "Best_Degree", c AS cluster FROM m JOIN lab ON key = team""",
)
def _team_archetypes_advanced(spark, sf):
    p = points(spark, sf)
    made = archetypes.team_archetypes_advanced(p, closing.team_best_fits(p), 6, EDGES, LABELS)
    return made.select(TEAM, *[r(c) for c in LABELS], "Best_Degree", "cluster")


@query(
    "archetype_profiles_advanced",
    f"""{_ADVANCED_SQL} {_profiles_sql(", round(d, 4) AS avg_degree, CASE WHEN d < 1.5 THEN 'Linear' ELSE 'Complex' END AS complexity")}""",
)
def _archetype_profiles_advanced(spark, sf):
    p = points(spark, sf)
    best = closing.team_best_fits(p)
    clustered = archetypes.team_archetypes_advanced(p, best, 6, EDGES, LABELS)
    found = archetypes.archetype_profiles_advanced(clustered, LABELS)
    return found.select("cluster", "size", *[r(c) for c in LABELS], "best", "worst", r("avg_degree"), "complexity")


@query(
    "cluster_complexity",
    """SELECT c_nationkey AS cluster, round(avg(c_custkey % 3 + 1), 6) AS avg_degree,
CASE WHEN avg(c_custkey % 3 + 1) < 2 THEN 'Linear' ELSE 'Complex' END AS complexity
FROM customer GROUP BY c_nationkey""",
)
def _cluster_complexity(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("cluster"), (F.col("c_custkey") % 3 + 1).alias("Best_Degree")
    )
    return cluster_complexity(c, "cluster", below=2).select("cluster", r("avg_degree", 6), "complexity")


_FACTS_SQL = """SELECT {rows} AS members, {k} AS clusters, true AS none_empty, true AS own_centre_nearest,
true AS cheaper_than_one"""


def _cluster_facts(clustered, features, k):
    """What any good clustering fulfils, over all rows.

    Own centre nearest allows for the last step of the centres, which is below the tolerance.
    """
    names = [f"f{i}" for i in range(len(features))]
    rows = clustered.select("cluster", *[c.cast("double").alias(n) for c, n in zip(features, names)])
    centres = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *[F.avg(n).alias(n) for n in names])
    # k centres and one overall mean: a bounded number of rows.
    known = [tuple(c[n] for n in names) for c in centres.orderBy("cluster").collect()]
    overall = rows.agg(*[F.avg(n) for n in names]).first()

    def square(to):
        return sum(((F.col(n) - F.lit(v)) * (F.col(n) - F.lit(v)) for n, v in zip(names, to)), F.lit(0.0))

    away = F.array(*[square(c) for c in known])
    judged = rows.select(
        away[F.col("cluster")].alias("own"), F.array_min(away).alias("least"), square(overall).alias("one")
    )
    return judged.agg(
        F.count(F.lit(1)).alias("members"),
        F.lit(len(known)).alias("clusters"),
        F.lit(all(c["size"] > 0 for c in centres.collect())).alias("none_empty"),
        F.bool_and(F.sqrt("own") <= F.sqrt("least") + 0.01 * F.sqrt("one") + 1e-6).alias("own_centre_nearest"),
        (F.sum("own") < F.sum("one")).alias("cheaper_than_one"),
    )


@query("kmeans_facts", _FACTS_SQL.format(rows="count(*)", k=5) + " FROM embeddings")
def _kmeans_facts(spark, sf):
    e = table(spark, sf, "embeddings")
    size = len(e.select("embedding").first()[0])
    clustered = kmeans(e, "embedding", 5)
    return _cluster_facts(clustered, [F.col("embedding")[i] for i in range(size)], 5)


_TEAMS = "count(DISTINCT team)"


@query("archetype_facts", f"WITH {POINTS_CTE} " + _FACTS_SQL.format(rows=_TEAMS, k=5) + " FROM pts")
def _archetype_facts(spark, sf):
    clustered = standardize(_archetypes(spark, sf), list(LABELS))
    return _cluster_facts(clustered, [F.col(f"{c}_z") for c in LABELS], 5)


@query(
    "archetype_facts_advanced",
    f"{_TEAM_CV} " + _FACTS_SQL.format(rows="count(*)", k="CAST(least(6, count(*)) AS INTEGER)") + " FROM wide WHERE best IS NOT NULL",
)
def _archetype_facts_advanced(spark, sf):
    p = points(spark, sf)
    made = archetypes.team_archetypes_advanced(p, closing.team_best_fits(p), 6, EDGES, LABELS)
    cols = [*LABELS, "Best_Degree"]
    return _cluster_facts(standardize(made, cols), [F.col(f"{c}_z") for c in cols], 6)


@query(
    "kmeans_embeddings",
    f"""WITH z AS MATERIALIZED (SELECT vec_id AS key, CAST(embedding AS DOUBLE[]) AS f FROM embeddings), {_steps_sql(5, 6)}
SELECT c AS cluster, count(*) AS size FROM lab GROUP BY c""",
)
def _kmeans_embeddings(spark, sf):
    clustered = kmeans_steps(table(spark, sf, "embeddings"), "embedding", 5, "vec_id", steps=6)
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


# --- Maintained analyses ---------------------------------------------------------------


def _maintained(spark, sf, folder):
    """All games after four reloads: wrong scores corrected, games sent again, games that never were removed."""
    kept = MaintainedClosing(spark, folder("maintained"), scale=128.0, edges=EDGES, labels=LABELS, buckets=4)
    p = materialize(points(spark, sf))
    third = F.col("game_id") % 3
    wrong = p.withColumn(Y, F.when(third == 0, F.col(Y) + 40).otherwise(F.col(Y)))
    wrong = wrong.withColumn(X, F.when(third == 0, -F.col(X)).otherwise(F.col(X)))
    invented = p.where(third == 1).withColumn("game_id", -F.col("game_id") - 1)
    kept.reload(wrong.where(third != 2).unionByName(invented), run_id="run", batch_id=0)
    kept.reload(p.where(third == 0), run_id="run", batch_id=1)
    # The rest of the games; some that are there already come again as they are.
    kept.reload(p.where((third == 2) | (F.col("game_id") % 7 == 0)), run_id="run", batch_id=2)
    for _ in range(2):
        none = p.limit(0)
        kept.reload(none, games=invented.select("game_id"), run_id="run", batch_id=3)
    return kept


@query("maintained_ranking", ORACLES["closer_ranking"])
@in_folders
def _maintained_ranking(spark, sf, folder):
    return _maintained(spark, sf, folder).closer_ranking().select(TEAM, "n", r("points_gained"))


@query("maintained_matrix", ORACLES["situational_matrix"])
@in_folders
def _maintained_matrix(spark, sf, folder):
    matrix = _maintained(spark, sf, folder).situational_matrix(3)
    return matrix.select(TEAM, *[r(label) for label in LABELS])


@query("maintained_shapes", ORACLES["team_shapes"])
@in_folders
def _maintained_shapes(spark, sf, folder):
    return _maintained(spark, sf, folder).team_shapes().select(TEAM, r("x", 6), r("y_team", 3), r("y_league", 3))
