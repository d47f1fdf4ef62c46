"""Analyses from maintained sums equal those recomputed from all points."""

import os
import random

import pytest
from pyspark.sql import functions as F

from courtstats.plans import closing
from courtstats.plans.maintained import MaintainedClosing

SCHEMA = "game_id string, season string, Team string, Side string, Q3_Lead double, Final_Result double"


def game(rng, name, season="s1"):
    home, away = rng.sample("ABCDEF", 2)
    lead, final = rng.randint(-30, 30), rng.randint(-40, 40)
    return [(name, season, home, "home", float(lead), float(final)), (name, season, away, "away", -float(lead), -float(final))]


def table(spark, games):
    return spark.createDataFrame([r for g in games for r in g], SCHEMA)


def close(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-9)


def test_reloads_equal_a_full_recompute(spark, tmp_path, rows):
    rng = random.Random(1)
    now = {f"g{i}": game(rng, f"g{i}") for i in range(60)}
    kept = MaintainedClosing(spark, str(tmp_path / "m"), buckets=4)
    kept.reload(table(spark, now.values()))
    for turn in range(3):
        names = rng.sample(sorted(now), 7)
        sent = {n: game(rng, n) for n in names[:4]} | {f"new{turn}": game(rng, f"new{turn}")}
        sent |= {names[6]: now[names[6]]}  # as it is
        gone = names[4:6]
        now = {n: g for n, g in (now | sent).items() if n not in gone}
        kept.reload(table(spark, sent.values()), spark.createDataFrame([(g,) for g in gone], "game_id string"))
        full = table(spark, now.values())
        assert rows(kept.points()) == rows(full.drop("season"))
        close(rows(kept.closer_ranking()), rows(closing.closer_ranking(full)))
        close(rows(kept.situational_matrix(fill=0.0)), rows(closing.situational_matrix(full, fill=0.0)))
        a, b = rows(kept.team_shapes(grid=5)), rows(closing.team_shapes(full, grid=5))
        assert [r[:2] for r in a] == [r[:2] for r in b]
        assert [r[2:] for r in a] == [pytest.approx(r[2:], abs=1e-6) for r in b]


def test_sums_of_whole_numbers_come_back_exactly(spark, tmp_path, rows):
    rng = random.Random(2)
    kept = MaintainedClosing(spark, str(tmp_path / "m"), buckets=2)
    first = [game(rng, f"g{i}") for i in range(30)]
    kept.reload(table(spark, first))
    before = rows(kept.store.read("sums"))
    for n in range(3):
        kept.reload(table(spark, [game(rng, f"g{i}") for i in range(n, 20)]))
    kept.reload(table(spark, first))
    assert rows(kept.store.read("sums")) == before


def test_a_reload_reads_and_writes_what_it_touches(spark, tmp_path, rows):
    rng = random.Random(3)
    kept = MaintainedClosing(spark, str(tmp_path / "m"), buckets=4)
    for n in range(6):
        kept.reload(table(spark, [game(rng, f"g{n}_{i}") for i in range(40)]))
    base = kept.store.latest()
    folders = sum(len(c) for c in base.tables["points"].folders.values())
    one = spark.createDataFrame([("g3_7",)], "game_id string")
    read = kept.store.candidates(base, "points", one)
    assert folders >= 20 and len({os.path.dirname(f) for f in read.inputFiles()}) <= 2
    same = kept.points().where("game_id = 'g3_7'").withColumn("season", F.lit("s1")).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    now = kept.reload(same)
    assert now.tables["points"] == base.tables["points"] and now.tables["sums"] == base.tables["sums"]


def test_seasons_nulls_and_batches_run_again(spark, tmp_path, rows):
    rng = random.Random(4)
    games = [game(rng, f"g{i}", f"s{i % 2}") for i in range(30)]
    odd = [[(None, "s1", "A", "home", 4.0, 7.0)], [("x", "s1", None, "home", 4.0, 7.0), ("x", "s1", "B", "away", None, 7.0)]]
    kept = MaintainedClosing(spark, str(tmp_path / "m"), by=["season"], buckets=2)
    for _ in range(2):
        kept.reload(table(spark, games + odd), run_id="r", batch_id=0)
    full = table(spark, games + odd[:1])
    expected = []
    for season in ("s0", "s1"):
        part = closing.closer_ranking(full.where(F.col("season") == season))
        expected += [(season, *r) for r in rows(part)]
    got = rows(kept.closer_ranking())
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected], abs=1e-9)
    # The game without a key goes when it is sent again without points.
    kept.reload(table(spark, []), spark.createDataFrame([(None,)], "game_id string"), run_id="r", batch_id=1)
    assert kept.points().where("game_id IS NULL").count() == 0
    # An older version still has it.
    assert kept.points(1).where("game_id IS NULL").count() == 1


def test_all_games_removed(spark, tmp_path, rows):
    kept = MaintainedClosing(spark, str(tmp_path / "m"), buckets=2)
    rng = random.Random(5)
    kept.reload(table(spark, [game(rng, "a"), game(rng, "b")]))
    kept.reload(table(spark, []), spark.createDataFrame([("a",), ("b",)], "game_id string"))
    assert rows(kept.points()) == [] and rows(kept.closer_ranking()) == []
    with pytest.raises(ValueError, match="degrees"):
        kept.sums(4, [])
