import glob
import os

import pytest
from pyspark.sql import functions as F

from courtstats import session
from courtstats.schemas import registry, table_schema
from courtstats.sources import landing as L
from courtstats.sources import tables as T
from courtstats.streaming.incremental import (
    Endpoint,
    RowFacet,
    complete_keys,
    incremental_load,
    load_batch,
    load_endpoints,
    loaded_keys,
    read_loaded,
    unique_rows,
)

PLAYS = "game_id string, event_num int, v string"


def plays(spark, *rows):
    return spark.createDataFrame(list(rows), PLAYS)


def test_csv_keeps_leading_zeros(spark, tmp_path, rows):
    path = str(tmp_path / "fits")
    T.write_csv(spark.createDataFrame([("0022300001", 2)], "id string, d int"), path)
    assert rows(T.scan_csv(spark, path, "id string, d int", ["id"])) == [("0022300001",)]


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = plays(spark, ("a", 1, "x"))
    T.write_append(df, path)
    T.write_append(df, path)
    assert T.scan(spark, path).count() == 2
    T.write_replace(df, path)
    assert T.scan(spark, path, ["v"]).collect()[0].v == "x" and T.scan(spark, path).count() == 1


def test_replace_by_key_is_idempotent_and_keeps_other_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = plays(spark, *[(f"g{i}", e, "old") for i in range(20) for e in range(3)])
    T.replace_by_key(first, path, ["game_id"], "first", buckets=4)
    again = plays(spark, ("g3", 0, "new"), ("g99", 0, "new"))
    for _ in range(2):
        T.replace_by_key(again, path, ["game_id"], "again", buckets=4)
        got = rows(T.scan(spark, path).select("game_id", "event_num", "v"))
        assert len(got) == 19 * 3 + 2
        assert [r for r in got if r[0] in ("g3", "g99")] == [("g3", 0, "new"), ("g99", 0, "new")]


def test_replace_by_key_refuses_a_table_without_a_layout(spark, tmp_path, rows):
    path = str(tmp_path / "plays")
    old = plays(spark, ("a", 1, "old"), ("b", 1, "old")).withColumn("bucket", T.key_bucket(["game_id"], 1))
    old.write.partitionBy("bucket").parquet(path)
    with pytest.raises(ValueError, match="no layout"):
        T.replace_by_key(plays(spark, ("a", 1, "new")), path, ["game_id"], "one", buckets=1)
    assert spark.read.parquet(path).count() == 2


def test_replace_by_key_resumes_a_failed_swap(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    T.replace_by_key(plays(spark, ("a", 1, "old"), ("b", 1, "old")), path, ["game_id"], buckets=1, batch_id="one")
    # Stage the second batch, but fail before the swap.
    calls = []

    def fail_second(df, parts):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return df.hint("rebalance", *parts)

    monkeypatch.setattr(T, "_by_bucket", fail_second)
    batch = plays(spark, ("a", 1, "new"))
    with pytest.raises(RuntimeError):
        T.replace_by_key(batch, path, ["game_id"], buckets=1, batch_id="two")
    monkeypatch.undo()
    # The table is now damaged, as by a crash amid the swap; staging still has all of it.
    plays(spark, ("broken", 1, "x")).withColumn("bucket", F.lit(0)).write.mode("overwrite").partitionBy(
        "bucket"
    ).parquet(path)
    T.replace_by_key(batch, path, ["game_id"], buckets=1, batch_id="two")
    assert rows(T.scan(spark, path).select("game_id", "v")) == [("a", "new"), ("b", "old")]
    # Staging is gone: the first batch, sent again, keeps what other batches changed.
    T.replace_by_key(plays(spark, ("c", 1, "x")), path, ["game_id"], buckets=1, batch_id="three")
    T.replace_by_key(batch, path, ["game_id"], buckets=1, batch_id="two")
    assert rows(T.scan(spark, path).select("game_id", "v")) == [("a", "new"), ("b", "old"), ("c", "x")]


def test_create_and_reset(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    assert set(T.create_all(spark, database="silver")) == set(registry())
    for name, schema in registry().items():
        assert spark.table(f"silver.{name}").schema.names == schema.names
    row = spark.createDataFrame([(1, "AAA", None, None, None, 1946, None)], table_schema("teams"))
    row.write.insertInto("silver.teams")
    T.create_all(spark, database="silver")
    assert spark.table("silver.teams").count() == 1
    T.reset_table(spark, "teams", "silver")
    assert spark.table("silver.teams").count() == 0
    with pytest.raises(ValueError):
        T.reset_table(spark, "teams; drop", "silver")


def test_landing_unions_result_sets(spark, tmp_path, rows):
    root = str(tmp_path / "landing")
    for i in (0, 1):
        L.land(spark.createDataFrame([(f"00{i}", i)], "GAME_ID string, n int"), root, "rotation", i)
    both = L.scan_landing(spark, root, "rotation", "GAME_ID string, n int", [0, 1], with_file=True)
    assert rows(both, "GAME_ID", "n") == [("000", 0), ("001", 1)]
    assert all("rotation" in r.source_file for r in both.collect())


def test_replace_by_key_with_null_keys_and_seasons(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "game_id string, season string, v string"

    def send(batch_id, *sent, **options):
        T.replace_by_key(
            spark.createDataFrame(list(sent), schema), path, ["game_id"], batch_id, **({"buckets": 4, "partition_by": ["season"]} | options)
        )

    send(1, ("a", "s1", "old"), (None, "s1", "old"), ("b", "s2", "old"))
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/season=s1/*/*.parquet")}
    send(2, ("b", "s2", "new"), ("c", "s2", "new"))
    assert before == {p: os.path.getmtime(p) for p in glob.glob(f"{path}/season=s1/*/*.parquet")}
    for n in (3, 4):
        send(n, (None, "s1", "new"))
        assert rows(T.scan(spark, path), "game_id", "season", "v") == sorted(
            [("a", "s1", "old"), (None, "s1", "new"), ("b", "s2", "new"), ("c", "s2", "new")], key=repr
        )
    with pytest.raises(ValueError, match="layout"):
        send(5, ("a", "s1", "x"), buckets=5)


def facets():
    return {
        "play_by_play": unique_rows(lambda df: df, ["game_id", "event_num"], ["v"]),
        "games": RowFacet(lambda df: df.select("game_id").distinct(), ["game_id"]),
    }


def test_incremental_load_keeps_every_row_once(spark, tmp_path, rows):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")

    def run(progress):
        stream = L.stream_landing(spark, landing, PLAYS, "json", files_per_batch=1)
        incremental_load(stream, root, str(tmp_path / progress), facets(), ["game_id"])

    def state():
        return rows(read_loaded(spark, root, "play_by_play"), "game_id", "event_num", "v")

    plays(spark, ("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x")).coalesce(1).write.json(landing)
    run("cp")
    assert state() == [("a", 1, "x"), ("a", 2, "x")]
    # Two later files: the rest of the game, a row sent again, a new game, a row without a game.
    plays(spark, ("a", 3, "x"), ("a", 1, "z")).coalesce(1).write.mode("append").json(landing)
    plays(spark, ("b", 1, "x"), (None, 1, "x"), ("a", 4, "x")).coalesce(1).write.mode("append").json(landing)
    expected = sorted([("a", n, "x") for n in (1, 2, 3, 4)] + [("b", 1, "x"), (None, 1, "x")], key=repr)
    for progress in ("cp", "cp", "lost", "lost"):
        # A new checkpoint reads all files anew, with batch numbers from zero.
        run(progress)
        assert state() == expected
    assert rows(loaded_keys(spark, root, ["game_id"])) == sorted([("a",), ("b",), (None,)], key=repr)
    assert rows(read_loaded(spark, root, "games")) == sorted([("a",), ("b",), (None,)], key=repr)


def test_a_batch_run_again_changes_nothing(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    load_batch(plays(spark, ("a", 1, "x")), 0, root, facets(), ["game_id"], "run")
    for _ in range(2):
        load_batch(plays(spark, ("a", 1, "z"), ("b", 1, "x")), 1, root, facets(), ["game_id"], "run")
        assert rows(read_loaded(spark, root, "play_by_play")) == [("a", 1, "x"), ("b", 1, "x")]


def test_a_broken_batch_leaves_no_row_twice(spark, tmp_path, rows):
    root = str(tmp_path / "out")

    def broken(df):
        raise RuntimeError("facet failed")

    batch = plays(spark, ("a", 1, "x"))
    bad = {**facets(), "hustle": RowFacet(broken, ["game_id"])}
    with pytest.raises(RuntimeError):
        load_batch(batch, 0, root, bad, ["game_id"], "one")
    assert not os.path.exists(f"{root}/_loaded_keys")
    # The checkpoint is lost as well: another run writes the batch.
    load_batch(batch, 0, root, facets(), ["game_id"], "two")
    assert rows(read_loaded(spark, root, "play_by_play")) == [("a", 1, "x")]


def test_games_are_done_with_all_endpoints(spark, tmp_path, rows):
    root, ends = str(tmp_path / "out"), {}
    for name, games in (("plays", "abc"), ("hustle", "ac"), ("rotations", "cb")):
        folder = str(tmp_path / name)
        plays(spark, *[(g, 1, name) for g in games]).write.json(folder)
        ends[name] = Endpoint(
            L.stream_landing(spark, folder, PLAYS), {"rows": RowFacet(lambda df: df, ["game_id", "event_num"])}
        )
    load_endpoints(ends, root, str(tmp_path / "cp"), ["game_id"])
    tables = [f"{name}/rows" for name in ends]
    assert rows(complete_keys(spark, root, tables, ["game_id"])) == [("c",)]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x").startswith(session.shared_folder(spark))
    kept = session.materialize(spark.range(5))
    assert kept.count() == 5 and "ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()
