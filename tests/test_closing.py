import re

import pytest

from courtstats.plans import archetypes, closing

EVENTS = "game_id string, event_num int, period int, score_home string, score_away string"


@pytest.fixture
def plays(spark):
    return spark.createDataFrame(
        [
            # Out of order, overtime, and a regulation tie.
            ("001", 9, 4, "100", "100"), ("001", 2, 3, "70", "60"), ("001", 1, 3, "68", "60"),
            ("001", 5, 4, "90", "95"), ("001", 12, 5, "110", "104"),
            # The last row of period 3 is blank.
            ("002", 1, 2, "40", "41"), ("002", 3, 3, "71", "80"), ("002", 4, 3, "", ""), ("002", 8, 4, "99", "101"),
            # No fourth period.
            ("003", 1, 3, "50", "40"),
            # Null scores at the end.
            ("004", 1, 3, "50", "40"), ("004", 2, 4, "80", "81"), ("004", 3, 4, None, None),
        ],
        EVENTS,
    )


def test_period_ends_take_the_last_event(plays, rows):
    assert rows(closing.period_end_scores(plays)) == [("001", 70.0, 60.0, 100.0, 100.0)]


def test_overtime_counts_on_request(plays, rows):
    got = rows(closing.period_end_scores(plays, final_period=None))
    assert ("001", 70.0, 60.0, 110.0, 104.0) in got
    assert ("003", 50.0, 40.0, 50.0, 40.0) in got


def test_blank_scores_are_carried_on_request(plays, rows):
    assert rows(closing.period_end_scores(plays, blank="carry")) == [
        ("001", 70.0, 60.0, 100.0, 100.0),
        ("002", 71.0, 80.0, 99.0, 101.0),
        ("004", 50.0, 40.0, 80.0, 81.0),
    ]


def test_closing_games_filters_seasons_and_stacks(spark, plays, rows):
    games = spark.createDataFrame(
        [("001", "22024", 1, 2), ("002", "22024", 2, 1), ("004", "42024", 1, 2)],
        "game_id string, season_id string, home_team_id long, away_team_id long",
    )
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "team_id long, abbreviation string")
    got = rows(closing.closing_games(games, plays, teams, ["22024"]))
    assert got == [("001", "AAA", "home", 10.0, 0.0), ("001", "BBB", "away", -10.0, 0.0)]
    every = closing.closing_games(games, plays, teams, blank="carry")
    assert every.count() == 6
    assert every.groupBy().sum("Q3_Lead", "Final_Result").first()[:] == (0.0, 0.0)
    assert closing.closing_games(games, plays, teams, ["22024", "42024"], blank="carry").count() == 6


def test_season_filter_prunes_a_partitioned_event_table(spark, plays, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "plays")
    plays.withColumn("season_id", F.lit("22024")).write.partitionBy("season_id").parquet(path)
    games = spark.createDataFrame(
        [("001", "22024", 1, 2)], "game_id string, season_id string, home_team_id long, away_team_id long"
    )
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "team_id long, abbreviation string")
    events = spark.read.schema(EVENTS + ", season_id string").parquet(path)
    out = closing.closing_games(games, events, teams, ["22024"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*season_id", plan)
    assert out.count() == 2


@pytest.fixture(scope="module")
def points(spark):
    import random

    rng = random.Random(4)
    rows = []
    for i in range(600):
        home, away = rng.sample(["AAA", "BBB", "CCC", "DDD", "EEE", "FFF"], 2)
        lead = float(rng.randint(-30, 30))
        final = lead * 0.9 + rng.gauss(3 if home == "AAA" else 0, 8)
        rows += [(f"g{i}", home, "home", lead, final), (f"g{i}", away, "away", -lead, -final)]
    return spark.createDataFrame(
        rows, "game_id string, Team string, Side string, Q3_Lead double, Final_Result double"
    ).persist()


def test_ranking_and_ends(points):
    ranking = closing.closer_ranking(points).orderBy("points_gained", ascending=False).collect()
    assert ranking[0].Team == "AAA" and len(ranking) == 6
    weighted = sum(r.n * r.points_gained for r in ranking)
    assert abs(weighted) < 1e-6
    ends = closing.closers(points, 2).collect()
    assert [r.Team for r in ends if r.side == "best"] == [r.Team for r in ranking[:2]]


def test_situational_matrix_equals_row_level_residuals(points):
    from pyspark.sql import functions as F

    from courtstats.functions.columns import cut
    from courtstats.operators import fit
    from courtstats.operators.aggregates import pivot_mean
    from courtstats.schemas import SITUATION_EDGES, SITUATION_LABELS

    X, Y = closing.X, closing.Y
    rows = fit.with_expected(points, fit.poly_fit(points, X, Y, 3), X, Y, 3)
    rows = rows.withColumn("s", cut(F.col(X), SITUATION_EDGES, SITUATION_LABELS))
    slow = {r[0]: r[1:] for r in pivot_mean(rows, "Team", "s", "residual", SITUATION_LABELS).collect()}
    fast = {r[0]: r[1:] for r in closing.situational_matrix(points).collect()}
    assert set(slow) == set(fast)
    for team in slow:
        assert fast[team] == pytest.approx(slow[team])


def test_team_shapes_skip_small_teams(spark, points):
    extra = spark.createDataFrame([("x", "TINY", "home", 1.0, 2.0)], points.schema)
    shapes = closing.team_shapes(points.unionByName(extra), grid=10)
    assert {r.Team for r in shapes.select("Team").distinct().collect()} == {"AAA", "BBB", "CCC", "DDD", "EEE", "FFF"}
    assert shapes.count() == 60


def test_degree_tuning_marks_one_winner(points):
    got = closing.degree_tuning(points).collect()
    assert sorted(r.degree for r in got) == [1, 2, 3, 4, 5]
    best = [r for r in got if r.best]
    assert len(best) == 1 and best[0].mse == min(r.mse for r in got)


def test_archetypes(points):
    clustered = archetypes.team_archetypes(points, k=2)
    profiles = archetypes.archetype_profiles(clustered).collect()
    assert sum(r["size"] for r in profiles) == 6 and len(profiles) == 2
    best = closing.team_best_fits(points)
    advanced = archetypes.team_archetypes_advanced(points, best, k=2)
    labelled = archetypes.archetype_profiles_advanced(advanced).collect()
    assert {r.complexity for r in labelled} <= {"Linear", "Complex"}
