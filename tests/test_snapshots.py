"""Versioned tables: what readers see, conflicts, the key index and folding of folders."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from courtstats import files
from courtstats.operators import dealing
from courtstats.sources import snapshots as S
from courtstats.streaming import incremental as I

PLAYS = "game_id string, event_num int, v string"


def plays(spark, *rows):
    return spark.createDataFrame(list(rows), PLAYS)


def games(spark, first, last, v="x", events=3):
    return plays(spark, *[(f"g{i:04d}", e, v) for i in range(first, last) for e in range(events)])


@pytest.fixture
def store(spark, tmp_path):
    return S.SnapshotTables(spark, str(tmp_path / "store"), buckets=4, max_folders=3)


def append(store, rows, keys=("game_id",)):
    base = store.latest()
    return store.commit(base, [store.stage(base, "plays", rows, list(keys))])


def test_readers_keep_their_version(spark, store, rows):
    store.replace("plays", plays(spark, ("a", 1, "old"), ("b", 1, "old"), (None, 1, "old")), ["game_id"])
    before = store.read("plays")
    store.replace("plays", plays(spark, ("a", 1, "new"), (None, 2, "new")), ["game_id"])
    assert rows(before, "game_id", "v") == sorted([("a", "old"), ("b", "old"), (None, "old")], key=repr)
    assert rows(store.read("plays"), "game_id", "v") == sorted([("a", "new"), ("b", "old"), (None, "new")], key=repr)
    assert rows(store.read("plays", 1)) == rows(before)
    assert store.numbers() == [1, 2]


def test_a_table_that_is_not_there_and_empty_batches(spark, store, rows):
    assert store.latest().number == 0
    with pytest.raises(KeyError):
        store.read("plays")
    append(store, plays(spark))
    assert rows(store.read("plays")) == [] and store.read("plays").schema.simpleString() == plays(spark).schema.simpleString()
    append(store, plays(spark, ("a", 1, "x")))
    append(store, plays(spark))
    assert rows(store.read("plays")) == [("a", 1, "x")]


def test_writers_of_one_bucket_conflict_and_others_do_not(spark, tmp_path, rows):
    store = S.SnapshotTables(spark, str(tmp_path / "s"), buckets=64)
    append(store, games(spark, 0, 20))
    base = store.latest()
    mine = store.stage_replacement(base, "plays", plays(spark, ("g0003", 1, "mine")), ["game_id"])
    theirs = store.stage_replacement(base, "plays", plays(spark, ("g0003", 1, "theirs")), ["game_id"])
    other = store.stage_replacement(base, "plays", plays(spark, ("g0007", 1, "other")), ["game_id"])
    store.commit(base, [theirs])
    with pytest.raises(S.Conflict):
        store.commit(base, [mine])
    # Another bucket: the change goes on top of their version.
    store.commit(base, [other])
    got = rows(store.read("plays").where("v <> 'x'"), "game_id", "v")
    assert got == [("g0003", "theirs"), ("g0007", "other")]
    assert store.read("plays").count() == 20 * 3 - 6 + 2
    # replace() looks again by itself.
    store.replace("plays", plays(spark, ("g0003", 1, "mine")), ["game_id"])
    assert rows(store.read("plays").where("game_id = 'g0003'"), "v") == [("mine",)]


def test_a_version_is_created_once(spark, tmp_path):
    place = str(tmp_path / "deep" / "folder" / "v.json")
    assert files.create_text(spark, place, "first") and not files.create_text(spark, place, "second")
    assert files.read_text(spark, place) == "first"
    assert files.names(spark, os.path.dirname(place)) == ["v.json"]
    files.write_text(spark, place, "third")
    assert files.read_text(spark, place) == "third" and not files.exists(spark, place + "x")
    assert files.names(spark, str(tmp_path / "none")) == []


def test_a_batch_is_applied_once_per_run(spark, store, rows):
    for _ in range(2):
        store.replace("plays", plays(spark, ("a", 1, "x")), ["game_id"], "run", 4)
    assert store.numbers() == [1]
    store.replace("plays", plays(spark, ("a", 1, "y")), ["game_id"], "run", 5)
    store.replace("plays", plays(spark, ("a", 1, "z")), ["game_id"], "run", 4)
    assert rows(store.read("plays"), "v") == [("y",)]


def test_other_keys_or_columns_are_refused(spark, store):
    append(store, games(spark, 0, 3))
    with pytest.raises(ValueError, match="keyed"):
        append(store, games(spark, 0, 3), ["event_num"])
    with pytest.raises(ValueError, match="columns"):
        append(store, games(spark, 0, 3).withColumn("more", F.lit(1)))


def test_only_folders_that_may_hold_a_key_are_read(spark, tmp_path, rows):
    """A batch of one game reads a folder or two of the forty that the table has."""
    store = S.SnapshotTables(spark, str(tmp_path / "s"), buckets=4, max_folders=100)
    for n in range(10):
        append(store, games(spark, 100 * n, 100 * n + 100))
    base = store.latest()
    wanted = plays(spark, ("g0342", 1, "again"), ("g0342", 9, "late"))
    assert sum(len(c) for c in base.tables["plays"].folders.values()) == 40
    found = store.folders_for(base, "plays", wanted)
    assert 1 <= len(found) <= 2
    read = store.candidates(base, "plays", wanted)
    assert len({os.path.dirname(f) for f in read.inputFiles()}) == len(found)
    assert rows(read.where("game_id = 'g0342'"), "event_num") == [(0,), (1,), (2,)]
    assert rows(store.unseen(base, "plays", wanted, ["game_id", "event_num"])) == [("g0342", 9, "late")]
    # Unknown games read nothing, or what shares a bit with them.
    assert len(store.folders_for(base, "plays", plays(spark, ("zzz", 1, "x")))) <= 1


def test_every_key_is_found_by_its_index(spark, store):
    append(store, games(spark, 0, 500).unionByName(plays(spark, (None, 1, "x"))))
    append(store, games(spark, 500, 900))
    base = store.latest()
    again = games(spark, 0, 900).unionByName(plays(spark, (None, 1, "x")))
    assert store.unseen(base, "plays", again, ["game_id", "event_num"]).count() == 0


def test_full_buckets_are_written_as_one(spark, store, rows):
    for n in range(9):
        append(store, games(spark, 10 * n, 10 * n + 10))
        folders = store.latest().tables["plays"].folders
        assert max(map(len, folders.values())) <= store.max_folders
    assert rows(store.read("plays")) == rows(games(spark, 0, 90))
    assert rows(store.read("plays", 4)) == rows(games(spark, 0, 40))


def test_expired_versions_free_their_folders(spark, store, rows, tmp_path):
    for v in "abcd":
        store.replace("plays", games(spark, 0, 30, v), ["game_id"])
    staged = store.stage(store.latest(), "plays", games(spark, 50, 60), ["game_id"])
    assert store.expire(keep=1) == 3 and store.numbers() == [4]
    assert rows(store.read("plays")) == rows(games(spark, 0, 30, "d"))
    assert len(glob.glob(f"{tmp_path}/store/data/plays/commit=*")) == 2  # the live one and the staged one
    store.commit(store.latest(), [staged])
    assert store.read("plays").count() == 120


def facets():
    return {
        "plays": I.unique_rows(lambda df: df, ["game_id", "event_num"], ["v"]),
        "games": I.RowFacet(lambda df: df.select("game_id").distinct(), ["game_id"]),
    }


def test_a_batch_appears_in_all_tables_at_once(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    I.load_batch(games(spark, 0, 5), 0, root, facets(), ["game_id"], "run", buckets=4)
    store = S.SnapshotTables(spark, root)
    bad = {**facets(), "games": I.RowFacet(lambda df: df.select(F.raise_error(F.lit("broken")).cast("string").alias("game_id")), ["game_id"])}
    with pytest.raises(Exception, match="broken"):
        I.load_batch(games(spark, 5, 9), 1, root, bad, ["game_id"], "run", buckets=4)
    assert store.numbers() == [1] and rows(store.read("plays")) == rows(games(spark, 0, 5))
    I.load_batch(games(spark, 5, 9), 1, root, facets(), ["game_id"], "run", buckets=4)
    assert rows(store.read("plays")) == rows(games(spark, 0, 9)) and store.read("games").count() == 9


def test_two_runs_that_meet_keep_every_row_once(spark, tmp_path, rows, monkeypatch):
    """The other run commits between this run's look at the table and its commit."""
    root = str(tmp_path / "out")
    I.load_batch(games(spark, 0, 5), 0, root, facets(), ["game_id"], "one", buckets=2)
    real, calls = S.SnapshotTables.commit, []

    def late(self, base, changes, run_id=None, batch_id=None):
        if run_id == "one" and not calls:
            calls.append(1)
            I.load_batch(games(spark, 3, 8), 0, root, facets(), ["game_id"], "two", buckets=2)
        return real(self, base, changes, run_id, batch_id)

    monkeypatch.setattr(S.SnapshotTables, "commit", late)
    I.load_batch(games(spark, 4, 9), 1, root, facets(), ["game_id"], "one", buckets=2)
    assert rows(I.read_loaded(spark, root, "plays")) == rows(games(spark, 0, 9))


def test_stored_rows_are_not_broadcast(spark, store, rows):
    """However small the files: what they hold is sent to no driver."""
    append(store, games(spark, 0, 20))
    new = store.unseen(store.latest(), "plays", games(spark, 15, 25, "again"), ["game_id", "event_num"])
    assert sorted({r[0] for r in rows(new)}) == [f"g{i:04d}" for i in range(20, 25)]
    assert "BroadcastHashJoin" not in new._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_written_by_as_many_tasks_as_its_rows_need(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(dealing, "TASK_ROWS", 20)
    plain = {"plays": I.RowFacet(lambda df: df, ["game_id", "event_num"])}
    sent = [games(spark, 0, 100), games(spark, 50, 150, "again").unionByName(plays(spark, (None, 1, "none")))]
    for number, batch in enumerate(sent):
        I.load_batch(batch, number, str(tmp_path / "s"), plain, ["game_id"], "run", buckets=2)
    files_of = [glob.glob(f"{place}/bucket=0/*.parquet") for place in glob.glob(f"{tmp_path}/s/data/plays/commit=*")]
    assert len(files_of) == 2 and all(len(found) > 4 for found in files_of)
    expected = games(spark, 0, 100).unionByName(games(spark, 100, 150, "again")).unionByName(plays(spark, (None, 1, "none")))
    assert rows(I.read_loaded(spark, str(tmp_path / "s"), "plays")) == rows(expected)
