"""The plans the operators are written for: one scan, hash aggregates, no Python, pruned reads."""

import re

import pytest

from bindings import analysis, common, relational
from courtstats.operators import joins
from courtstats.plans import builds, closing, reports
from courtstats.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Lines of the executed plan, its subqueries included, without the initial plans."""
    df.collect()
    kept, skip_from = [], None
    for line in plan(df).split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip_from is not None and depth >= skip_from:
            continue
        skip_from = depth if "== Initial Plan ==" in line else None
        if skip_from is None:
            kept.append(line)
    return "\n".join(kept)


def test_both_period_ends_take_one_scan_and_a_hash_aggregate(spark):
    text = plan(closing.period_end_scores(common.events(spark, SF), ["user_id", "week"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert "partial_max_by" in text


@pytest.mark.parametrize("name", ["closer_ranking", "situational_matrix", "team_best_fits", "degree_tuning"])
def test_analyses_scan_the_events_once(spark, name):
    text = final_plan(common.QUERIES[name](spark, SF))
    assert len(re.findall(r"FileScan parquet \[event_id", text)) == 1, text
    assert "ReusedExchange" in text
    assert "Python" not in text and "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_a_season_prunes_the_events_before_they_are_aggregated(spark, tmp_path):
    games = spark.createDataFrame(
        [("a", "s1", 1, 2), ("b", "s2", 2, 1)], "game_id string, season_id string, home_team_id long, away_team_id long"
    )
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "team_id long, abbreviation string")
    plays = spark.createDataFrame(
        [(g, n, p, "1", "2") for g in "ab" for n, p in ((1, 3), (2, 4))],
        "game_id string, event_num int, period int, score_home string, score_away string",
    )
    points = closing.closing_games(games, plays, teams, ["s1"])
    text = plan(points)
    # Deeper lines come later: the semi-join feeds the partial aggregate.
    assert "LeftSemi" in text[text.index("partial_max_by") :]
    assert {r.game_id for r in points.collect()} == {"a"}
    stored = str(tmp_path / "plays")
    tables.replace_by_key(builds.with_season(plays, games), stored, ["game_id"], 1, 2, ["season_id"])
    by_season = spark.read.parquet(stored).drop("bucket")
    points = closing.closing_games(games, by_season, teams, ["s1"])
    assert re.search(r"PartitionFilters: \[[^\]]*season_id", plan(points))
    assert {r.game_id for r in points.collect()} == {"a"}


def test_scan_reads_only_what_it_needs(spark):
    text = plan(relational._scan_table(spark, SF))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(relational.unique_lines(spark, SF))
    assert re.search(r"WindowGroupLimit [^\n]*Partial", text)


def test_fill_and_rank_shuffle_the_rows_once(spark):
    for name in ("forward_fill", "rank_within"):
        text = plan(common.QUERIES[name](spark, SF))
        scans = re.split(r"FileScan", text)
        # Every path from a scan to the join passes one exchange on the chunk or hash digits.
        assert len(scans) == 3 and text.count("hashpartitioning(__part") == 2


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(relational._top_k(spark, SF))


def test_nemesis_cuts_all_inputs_before_the_fact_joins(spark):
    matchups, players, box_scores, _ = relational.matchup_tables(spark, SF)
    attacker = joins.one_player(players, "Customer#000000007")
    sides = joins.matchup_sides(matchups, box_scores, attacker)
    logical = sides._jdf.queryExecution().optimizedPlan().toString()
    # Both uses of the box scores and the matchups: the player's rows, and the player's games.
    assert "LeftSemi" in logical and logical.count(f"= {attacker}") >= 2, logical
    text = plan(relational._nemesis_report(spark, SF))
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_defender_totals_sort_only_in_the_last_step(spark):
    """The game id, a text, orders a defender's teams; all rows before that step are hashed."""
    facts = spark.range(10).selectExpr(
        "cast(id as string) as game_id", "id as off_player_id", "id as def_player_id", "1.0D as matchup_minutes",
        "1 as points_allowed", "1 as matchup_ast", "1 as matchup_tov",
    )
    box = spark.range(10).selectExpr("cast(id as string) as game_id", "id as player_id", "id as team_id")
    players = spark.range(10).selectExpr("id as player_id", "cast(id as string) as full_name")
    teams = spark.range(10).selectExpr("id as team_id", "cast(id as string) as abbreviation")
    text = plan(reports.defender_totals(joins.matchup_sides(facts, box), players, teams))
    assert text.count("SortAggregate") == 2 and text.count("HashAggregate") == 2
    assert text.rindex("SortAggregate") < text.index("HashAggregate")


def test_no_query_plan_uses_python(spark):
    for name in ("poly_cv_by_team", "team_shapes", "rank_within", "forward_fill", "matchup_join"):
        assert "Python" not in plan(common.QUERIES[name](spark, SF))
    assert analysis.EDGES[0] < analysis.EDGES[-1]
