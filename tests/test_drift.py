"""Files of drifting types: lattice, report, and the rows of the united table."""

import itertools

import pytest
from pyspark.sql import functions as F

from courtstats.sources import drift


def land(df, path, name):
    df.coalesce(1).write.parquet(f"{path}/{name}")


@pytest.mark.parametrize(
    "types, wide",
    [
        ("int", "int"), ("int bigint", "bigint"), ("bigint int double", "double"), ("int double", "double"),
        ("double string", "string"), ("date", "date"), ("date timestamp", "string"), ("boolean int", "string"),
    ],
)
def test_join_of_types(spark, types, wide):
    """The same in every order, and whichever types are joined first."""
    for order in itertools.permutations(types.split()):
        row = spark.range(1).select(drift.widest(F.array(*map(F.lit, order))).alias("t")).first()
        assert row["t"] == wide


def test_rows_of_all_loads(spark, tmp_path, rows):
    path = str(tmp_path)
    land(spark.sql("select 1 as a, 'x' as b, cast(3 as smallint) as s, null as n").drop("n"), path, "one")
    land(spark.sql("select 3000000000 as a, 'y' as b, 2.5D as c, 4 as s"), path, "two")
    land(spark.sql("select 0.5D as a, true as b, array(1, 2) as list, 5L as s"), path, "three")
    land(spark.sql("select cast(null as int) as a, date'2024-01-02' as b"), path, "four")
    df = drift.scan_drifting(spark, path)
    assert df.dtypes == [("a", "double"), ("b", "string"), ("c", "double"), ("list", "array<int>"), ("s", "bigint")]
    assert rows(df.select("a", "b", "c", "s", F.to_json("list"))) == sorted(
        [
            (1.0, "x", None, 3, None), (3e9, "y", 2.5, 4, None), (0.5, "true", None, 5, "[1,2]"),
            (None, "2024-01-02", None, None, None),
        ],
        key=repr,
    )
    told = {r["column"]: r for r in drift.drift_report(drift.footers(spark, path)).collect()}
    assert told["a"]["types"] == "bigint,double,int" and told["a"]["widened"] and told["a"]["inexact"]
    assert told["c"]["rows"] == 1 and not told["c"]["widened"]
    assert told["s"]["type"] == "bigint" and not told["s"]["inexact"]


def test_filters_and_columns_reach_every_scan(spark, tmp_path):
    path = str(tmp_path)
    land(spark.range(10).selectExpr("cast(id as int) as k", "id as v"), path, "one")
    land(spark.range(10).selectExpr("id as k", "id as w", "id as v"), path, "two")
    plan = drift.scan_drifting(spark, path).where("w > 3").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(w,3)" in plan and "v:" not in plan.split("ReadSchema")[-1]


def test_refused_folders(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no Parquet file"):
        drift.scan_drifting(spark, str(tmp_path / "none"))
    land(spark.sql("select 1 as a"), str(tmp_path / "case"), "one")
    land(spark.sql("select 1 as A"), str(tmp_path / "case"), "two")
    with pytest.raises(ValueError, match="case"):
        drift.scan_drifting(spark, str(tmp_path / "case"))
    land(spark.sql("select array(1) as a"), str(tmp_path / "nested"), "one")
    land(spark.sql("select 'x' as a"), str(tmp_path / "nested"), "two")
    with pytest.raises(ValueError, match="nested"):
        drift.scan_drifting(spark, str(tmp_path / "nested"))


def test_many_shapes_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(drift, "MAX_SHAPES", 1)
    land(spark.sql("select 1 as a"), str(tmp_path), "one")
    land(spark.sql("select 1L as a"), str(tmp_path), "two")
    with pytest.raises(ValueError, match="shapes"):
        drift.scan_drifting(spark, str(tmp_path))


def test_empty_files_and_odd_names(spark, tmp_path, rows):
    path = str(tmp_path)
    land(spark.sql("select 1 as `a.b`, 2 as `c d`").where("false"), path, "one")
    land(spark.sql("select 5L as `a.b`"), path, "two")
    df = drift.scan_drifting(spark, path)
    assert df.columns == ["a.b", "c d"] and rows(df) == [(5, None)]
