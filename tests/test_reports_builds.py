import datetime

import pytest
from pyspark.sql import functions as F

from courtstats.operators.joins import matchup_join
from courtstats.plans import builds, reports

LOG = "SEASON_ID string, TEAM_ID long, GAME_ID string, GAME_DATE string, MATCHUP string, WL string, PTS long"


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            ("22024", 1, "001", "2024-10-22", "AAA vs. BBB", "W", 110),
            ("22024", 2, "001", "2024-10-22", "BBB @ AAA", "L", 101),
            ("22024", 1, "002", "2024-10-23", "AAA @ CCC", "L", 90),
            ("42024", 3, "003", "2025-05-01", "CCC vs. AAA", None, None),
            ("42024", 1, "003", "2025-05-01", "AAA @ CCC", None, None),
        ],
        LOG,
    )


def test_build_games_pairs_finished_rows(log, rows):
    assert rows(builds.build_games([log.where("SEASON_ID = '22024'"), log.where("SEASON_ID = '42024'")])) == [
        ("001", datetime.date(2024, 10, 22), "22024", "AAA vs. BBB", 1, 2, 110, 101)
    ]


def test_scoreboard_and_incomplete(log, rows):
    board = {r.GAME_ID: r for r in reports.scoreboard(log, 4).collect()}
    assert set(board) == {"001", "002", "003"}
    assert board["003"].complete and not board["002"].complete
    # All rows of the last k games, whether or not the other games have two rows.
    assert board["001"].rows == 2
    assert [(r.GAME_ID, r.complete) for r in reports.scoreboard(log, 1).collect()] == [("003", True)]
    assert rows(reports.incomplete_games(log)) == [("002", 1)]


def test_load_plan(spark, log, rows):
    done = spark.createDataFrame([("001",), ("009",)], "game_id string")
    assert rows(reports.load_plan([log], done)) == [("002",)]
    assert tuple(reports.load_plan_status([log], done).first()) == (2, 2, 1)


@pytest.fixture
def match_tables(spark):
    players = spark.createDataFrame(
        [(1, "Star"), (2, "Twin"), (3, "Twin"), (4, "Mate")], "player_id long, full_name string"
    )
    teams = spark.createDataFrame([(10, "AAA"), (20, "BBB"), (30, "CCC")], "team_id long, abbreviation string")
    box = spark.createDataFrame(
        [("g1", 1, 10), ("g1", 2, 20), ("g1", 4, 10), ("g2", 1, 10), ("g2", 2, 30), ("g2", 3, 20)],
        "game_id string, player_id long, team_id long",
    )
    matchups = spark.createDataFrame(
        [
            ("g1", 10, 1, 2, 4.25, 10, 1, 2), ("g2", 10, 1, 2, 2.0, 3, 0, 1),
            ("g2", 10, 1, 3, 9.0, 8, 2, 0), ("g1", 10, 1, 4, 50.0, 99, 9, 9), ("g1", 20, 2, 1, 1.0, 1, 1, 1),
        ],
        "game_id string, team_id long, off_player_id long, def_player_id long, matchup_minutes double, "
        "points_allowed int, matchup_ast int, matchup_tov int",
    )
    return matchups, players, box, teams


def test_nemesis_report_keeps_namesakes_apart_and_drops_teammates(match_tables):
    got = [tuple(r) for r in reports.nemesis_report(*match_tables, attacker="Star").collect()]
    assert got == [
        (3, "Twin", "BBB", 1, "9.0", 8, 2, 0),
        (2, "Twin", "CCC", 2, "6.3", 13, 1, 3),
    ]
    assert len(reports.nemesis_report(*match_tables, attacker="Star", k=1).collect()) == 1
    assert matchup_join(*match_tables).count() == 4


def test_build_matchups(spark, rows):
    payload = spark.createDataFrame(
        [
            ("001", 1, 5.0, 6.0, "2:30", 2.5, 7), ("001", 1, 5.0, 6.0, "1:00", 1.0, 3),
            ("001", 1, 5.0, None, "3:00", 3.0, 1), ("001", 1, 6.0, 5.0, None, 0.75, 2),
        ],
        "gameId string, teamId long, personIdOff double, personIdDef double, matchupMinutes string, "
        "matchupMinutesSort double, playerPoints long",
    )
    got = rows(builds.build_matchups(payload), "off_player_id", "def_player_id", "matchup_minutes", "points_allowed")
    assert got == [(5, 6, 2.5, 7), (6, 5, 0.75, 2)]


def test_build_play_by_play_orders_duplicates(spark, rows):
    payload = spark.createDataFrame(
        [("001", 1, "late", 2), ("001", 1, "early", 1), ("001", 2, "x", 3)],
        "gameId string, actionNumber int, description string, sent int",
    )
    got = rows(builds.build_play_by_play(payload, ["sent"]), "event_num", "description")
    assert got == [(1, "early"), (2, "x")]
    assert builds.build_play_by_play(payload).count() == 2


def test_build_rotations_keeps_both_result_sets(spark):
    schema = "GAME_ID string, TEAM_ID long, PERSON_ID long, IN_TIME_REAL double, OUT_TIME_REAL double, PT_DIFF double"
    sets = [spark.createDataFrame([("001", t, t * 10, 0.0, 100.0, 3.0)], schema) for t in (1, 2)]
    got = builds.build_rotations(sets)
    assert {r.player_id for r in got.collect()} == {10, 20}
    assert got.select("row_id").distinct().count() == 2
    assert got.where(F.col("in_time_real").isNull() | F.col("pt_diff").isNull()).count() == 0
    ids = sorted(r.row_id for r in got.collect())
    assert ids == sorted(r.row_id for r in builds.build_rotations(sets[::-1]).collect())


def test_build_box_score_joins_facets(spark, rows):
    keys = "gameId string, personId long, teamId long"
    trad = spark.createDataFrame([("001", 1, 10, "30:00", 25)], keys + ", minutes string, points long")
    adv = spark.createDataFrame([("001", 1, 10, "other", 110.5)], keys + ", minutes string, offensiveRating double")
    misc = spark.createDataFrame([("001", 1, 10, 3)], keys + ", foulsPersonal int")
    got = builds.build_box_score(trad, adv, misc)
    assert rows(got, "game_id", "player_id", "minutes", "pts", "off_rating", "pf") == [
        ("001", 1, "30:00", 25, 110.5, 3)
    ]


def test_build_line_scores_accepts_both_shapes(spark, rows):
    camel = spark.createDataFrame(
        [("001", 1, "AAA", 20, 21, 22, 23, 5, 91)],
        "gameId string, teamId long, teamTricode string, period1Score int, period2Score int, period3Score int, "
        "period4Score int, period5Score int, score int",
    )
    upper = spark.createDataFrame(
        [("2024-10-22T00:00:00", "002", 2, "BBB", 1, 2, 3, 4, None, 10)],
        "GAME_DATE_EST string, GAME_ID string, TEAM_ID long, TEAM_ABBREVIATION string, PTS_QTR1 int, PTS_QTR2 int, "
        "PTS_QTR3 int, PTS_QTR4 int, PTS_OT10 int, PTS int",
    )
    got = builds.build_line_scores([camel, upper])
    assert rows(got, "GAME_ID", "PTS_QTR4", "PTS_OT1", "PTS_OT4", "PTS") == [("001", 23, 5, 0, 91), ("002", 4, 0, 0, 10)]
    late = camel.withColumn("period14Score", F.lit(3))
    assert rows(builds.build_line_scores([late]), "PTS_OT1", "PTS_OT10") == [(5, 3)]
    assert "PTS_OT2" not in builds.build_line_scores([camel], overtimes=1).columns
    with pytest.raises(Exception, match="more overtimes"):
        builds.build_line_scores([late], overtimes=4).collect()
    long = builds.line_scores_long([camel, upper])
    assert long.where("GAME_ID = '001'").agg(F.sum("pts")).first()[0] == 91


def test_build_dimensions_keep_the_declared_schema(spark):
    teams = spark.createDataFrame(
        [(1, "AAA", "City Hawks", "Hawks", "City", "ST", 1946)],
        "id long, abbreviation string, full_name string, nickname string, city string, state string, year_founded int",
    )
    row = builds.build_teams(teams).first()
    assert row.nickname == "City Hawks" and row.arena is None
    players = spark.createDataFrame(
        [(1, "A B", "A", "B", True)],
        "id long, full_name string, first_name string, last_name string, is_active boolean",
    )
    assert builds.build_players(players).first().school is None
