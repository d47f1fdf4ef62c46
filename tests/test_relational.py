import datetime
import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from courtstats.operators import aggregates as A
from courtstats.operators import joins as J
from courtstats.operators import ordering as O
from courtstats.operators import projection as P
from courtstats.operators import sets as U
from courtstats.operators import windows as W
from courtstats.schemas import ALIASES, table_schema


def test_conform_takes_first_alias_present(spark):
    payload = spark.createDataFrame(
        [("0022300001", 1, None, "away text", "12")],
        "gameId string, EVENTNUM int, HOMEDESCRIPTION string, VISITORDESCRIPTION string, period string",
    )
    schema = table_schema("play_by_play")
    first = P.conform(payload, schema, ALIASES).first()
    assert first["game_id"] == "0022300001" and first["event_num"] == 1
    assert first["period"] == 12 and first["description"] is None
    merged = P.conform(payload, schema, ALIASES, mode="coalesce").first()
    assert merged["description"] == "away text"
    assert P.conform(payload, schema, ALIASES).schema.names == schema.names


def test_conform_reads_both_payload_spellings(spark, rows):
    camel = spark.createDataFrame([("01", 5, 7)], "gameId string, personId long, points long")
    upper = spark.createDataFrame([("01", 5, 7)], "GAME_ID string, PLAYER_ID long, PTS long")
    schema = table_schema("player_game_stats")
    assert rows(P.conform(camel, schema, ALIASES)) == rows(P.conform(upper, schema, ALIASES))


def test_projection_helpers(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert rows(P.ensure_columns(df, ["b", "c"], 0)) == [(1, 0, 0), (2, 5, 0)]
    assert P.project_available(df, ["b", "z", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError):
        P.project(df, ["a", "z"])
    assert rows(P.drop_nulls(df)) == [(2, 5)]


def test_split_by_marker_is_literal(spark, rows):
    df = spark.createDataFrame([("AAA vs. BBB",), ("BBB @ AAA",), ("AAA vsx BBB",)], "m string")
    home, away = P.split_by_marker(df, "m")
    assert rows(home) == [("AAA vs. BBB",)] and rows(away) == [("BBB @ AAA",)]


def test_star_join_uses_a_dimension_twice(spark, rows):
    games = spark.createDataFrame([("g1", 1, 2), ("g2", 2, 9)], "g string, h long, a long")
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "team_id long, abbr string")
    out = J.star_join(
        games, [("h", teams, "team_id", {"abbr": "home"}), ("a", teams, "team_id", {"abbr": "away"})]
    )
    assert rows(out, "g", "home", "away") == [("g1", "AAA", "BBB")]


def test_merge_facets_keeps_the_first_owner_of_a_column(spark, rows):
    a = spark.createDataFrame([(1, 1, "12:00")], "p int, t int, minutes string")
    b = spark.createDataFrame([(1, 1, "other", 99.0)], "p int, t int, minutes string, rating double")
    c = spark.createDataFrame([(1, 1, 3, -1.0)], "p int, t int, misc int, rating double")
    out = J.merge_facets([a, b, c], ["p", "t"])
    assert out.columns == ["p", "t", "minutes", "rating", "misc"]
    assert rows(out) == [(1, 1, "12:00", 99.0, 3)]


def test_missing_keys_and_difference(spark, rows):
    target = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("c",), ("d",)], "k string")
    assert rows(J.missing_keys(target, done, ["k"])) == [("a",), ("b",)]
    assert rows(U.key_difference(done, target, ["k"])) == [("d",)]


def test_argmax_by_takes_the_whole_row(spark, rows):
    df = spark.createDataFrame(
        [("g", 3, 10.0, None), ("g", 9, None, "x"), ("g", 5, 30.0, "y"), ("h", 1, 1.0, "z")],
        "g string, o int, v double, s string",
    )
    assert rows(A.argmax_by(df, ["g"], "o", ["v", "s"])) == [("g", None, "x"), ("h", 1.0, "z")]


def test_pair_by_key_marks_incomplete(spark, rows):
    df = spark.createDataFrame(
        [("1", "b", 9), ("1", "a", 7), ("2", "x", 1), ("3", "p", 1), ("3", "q", 2), ("3", "r", 3)],
        "g string, m string, pts int",
    )
    assert rows(A.pair_by_key(df, "g", "m", ["m", "pts"])) == [
        ("1", 2, True, "a", 7, "b", 9),
        ("2", 1, False, None, None, None, None),
        ("3", 3, False, None, None, None, None),
    ]


def test_pivot_mean_keeps_all_labels(spark, rows):
    df = spark.createDataFrame([("t", "x", 1.0), ("t", "x", 2.0), ("u", None, 5.0)], "t string, c string, v double")
    assert rows(A.pivot_mean(df, "t", "c", "v", ["x", "y"])) == [("t", 1.5, None), ("u", None, None)]
    assert rows(A.pivot_mean(df, "t", "c", "v", ["x", "y"], 0)) == [("t", 1.5, 0.0), ("u", 0.0, 0.0)]


@pytest.mark.parametrize("count", [1, 2, 9, 1000, 1001])
def test_exact_median(spark, count):
    rng = random.Random(count)
    data = [float(rng.choice([rng.randint(-50, 50), 7])) for _ in range(count)]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    assert A.exact_median(df, "v").collect() == [(statistics.median(data),)]


def test_exact_median_of_weights_and_of_nothing(spark):
    rng = random.Random(3)
    data = [rng.gauss(0, 1) for _ in range(6001)] + [0.25] * 3000
    df = spark.createDataFrame([(v,) for v in data], "v double")
    assert A.exact_median(df, "v", "m").collect() == [(statistics.median(data),)]
    weighted = spark.createDataFrame([(1.0, 3), (2.0, 1), (5.0, 4)], "v double, n int")
    assert A.exact_median(weighted, "v", weight="n").collect() == [(3.5,)]
    assert A.exact_median(df.where("v > 100"), "v").collect() == [(None,)]


def test_members_and_lists(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c")], "g int, m string")
    assert rows(A.members(df, "g", "m")) == [(1, "a", 2), (1, "b", 2), (2, "c", 1)]
    assert rows(A.member_lists(df, "g", "m")) == [(1, "a, b", 2), (2, "c", 1)]


def test_pieces_follow_the_rows_not_the_order_values(spark):
    """One key holds half the rows at timestamps far apart, another at almost one time; no piece is large."""
    def moment(i):
        return datetime.datetime(2020, 1, 1) + datetime.timedelta(seconds=i**3 if i < 1500 else 1500**3 + i)

    rows = [("hot", moment(i), i) for i in range(3000)] + [(None, moment(i), i) for i in range(1000)]
    rows += [(f"g{i % 200}", moment(i), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, t timestamp, i int").repartition(5)
    cut = W.pieces(df, ["g"], "t", 100)
    sizes = [(r["g"], r["count"]) for r in cut.groupBy("g", "__piece").count().collect()]
    assert sum(n for _, n in sizes) == 6000 and max(n for _, n in sizes) <= 200
    assert {g for g, _ in sizes if sizes.count((g, 10)) == 0} >= {"hot", None}
    # Places sort like the rows.
    placed = sorted((r["g"] or "", r["__piece"], r["t"]) for r in cut.collect())
    assert placed == sorted(placed, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("fan_out", [2, 64])
def test_forward_fill_along_timestamps(spark, monkeypatch, fan_out):
    monkeypatch.setattr(W, "FAN_OUT", fan_out)
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (rng.choice(["hot", "hot", "hot", "a", None]), start + datetime.timedelta(seconds=7 * i * i), rng.choice([None, None, i]))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "g string, t timestamp, v int").repartition(6)
    expected, last = [], {}
    for g, t, v in rows:
        last[g] = v if v is not None else last.get(g)
        expected.append((g, t, last[g]))
    got = [tuple(r) for r in W.forward_fill(df, ["v"], ["g"], "t", chunk=40).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_forward_fill_across_chunks(spark, chunk):
    rng = random.Random(chunk)
    data = [(g, i, rng.choice([None, None, rng.random()])) for g in ("a", "b", None) for i in range(40)]
    expect = {}
    for g in ("a", "b", None):
        last = None
        for _, i, v in [d for d in data if d[0] == g]:
            last = v if v is not None else last
            expect[(g, i)] = last
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, i int, v double")
    got = W.forward_fill(df, ["v"], ["g"], "i", chunk=chunk)
    assert {(r.g, r.i): r.v for r in got.collect()} == expect
    assert got.count() == len(data)


def test_rank_within_equals_a_plain_rank(spark):
    data = [("hot", i) for i in range(700)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(data, "g string, k int")
    got = {(r.g, r.k): (r.rank, r.size) for r in W.rank_within(df, ["g"], ["k"], "rank", "size").collect()}
    for g, size in (("hot", 700), ("cold", 5)):
        order = sorted(range(size), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
        assert {k: got[(g, k)] for k in range(size)} == {k: (i + 1, size) for i, k in enumerate(order)}


def test_dedupe_keeps_the_first_in_order(spark, rows):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 5, "e")], "k int, o int, v string")
    assert rows(W.dedupe(df, ["k"], ["o"])) == [(1, 2, "b"), (2, 5, "e")]


def test_best_and_worst(spark, rows):
    df = spark.createDataFrame([(n, v) for n, v in zip("abcdef", [3, 1, 3, 2, 0, 0])], "n string, v int")
    got = rows(O.best_and_worst(df, "v", "n", 2))
    assert got == [("best", 1, "a", 3), ("best", 2, "c", 3), ("worst", 1, "f", 0), ("worst", 2, "e", 0)]


def test_sort_by_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 5.0), ("d", 5.0)], "n string, v double")
    assert [r.n for r in O.sort_by(df, "v", "n").collect()] == ["c", "d", "b", "a"]


def test_stack_sides_mirrors(spark, rows):
    df = spark.createDataFrame([("g1", "A", "B", 5.0, -3.0)], "g string, h string, a string, x double, y double")
    out = U.stack_sides(df, "h", "a", {"x": "X", "y": "Y"}, ["g"], "Team", "Side")
    assert rows(out) == [("g1", "A", "home", 5.0, -3.0), ("g1", "B", "away", -5.0, 3.0)]


def test_union_all_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(U.union_all([a, b])) == [(1, "x"), (2, None)]
    assert a.select(F.lit(1)).count() == 1
