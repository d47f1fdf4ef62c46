import numpy as np
import pytest
from pyspark.sql.types import StructType

from courtstats.operators import cluster as K
from courtstats.operators import quality as Q


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    got = sorted(tuple(r) for r in K.standardize(df, ["a", "b"]).select("a_z", "b_z").collect())
    a = np.array([1.0, 2.0, 6.0])
    assert [g[0] for g in got] == pytest.approx(list((a - a.mean()) / a.std()))
    assert [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_kmeans_finds_separate_groups(spark):
    rng = np.random.default_rng(1)
    centres = [(-10.0, 0.0), (0.0, 10.0), (10.0, -5.0)]
    data = [(i, *map(float, rng.normal(c, 0.3))) for i, c in enumerate(centres) for _ in range(20)]
    df = spark.createDataFrame(data, "truth int, a double, b double")
    got = K.kmeans(df, ["a", "b"], 3)
    # Labels follow the order of the centres, so they equal the truth here.
    assert got.where("truth != cluster").count() == 0
    profile = {r.cluster: r for r in K.cluster_profile(got, "cluster", ["a", "b"]).collect()}
    assert profile[0]["size"] == 20 and profile[0].best == "b" and profile[0].worst == "a"
    arrays = df.selectExpr("truth", "array(a, b) as v")
    assert K.kmeans(arrays, "v", 3).where("truth != cluster").count() == 0


def test_kmeans_with_fewer_distinct_rows_than_clusters(spark):
    two = spark.createDataFrame([(1.0, 1.0)] * 3 + [(5.0, 5.0)] * 2, "a double, b double")
    with pytest.warns(UserWarning, match="only 2 distinct rows for 4"):
        got = K.kmeans(two, ["a", "b"], 4).groupBy("cluster").count().collect()
    assert sorted((r["cluster"], r["count"]) for r in got) == [(0, 3), (1, 2)]
    one = two.where("a = 1")
    assert {r.cluster for r in K.kmeans(one, ["a", "b"], 1).collect()} == {0}
    with pytest.raises(ValueError, match="positive"):
        K.kmeans(one, ["a", "b"], 0)


def test_cluster_complexity(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (1, 3)], "cluster int, Best_Degree int")
    got = {r.cluster: (r.avg_degree, r.complexity) for r in K.cluster_complexity(df, "cluster").collect()}
    assert got == {0: (1.0, "Linear"), 1: (2.0, "Complex")}


def test_audit_reports_missing_tables_and_columns(spark):
    registry = {
        "a": StructType.fromDDL("x int, y string"),
        "b": StructType.fromDDL("x int"),
        "c": StructType.fromDDL("x int"),
    }
    tables = {
        "a": spark.createDataFrame([(1, 2)], "x int, z int"),
        "b": spark.createDataFrame([(1,)], "x long"),
    }
    audit = Q.audit_schema(spark, registry, tables, with_rows=True)
    got = {r.table_name: tuple(r)[1:] for r in audit.collect()}
    assert got == {
        "a": ("MISSING_COLUMNS", "y", "z", "", 1),
        "b": ("OK", "", "", "x", 1),
        "c": ("MISSING_TABLE", "x", "", "", None),
    }
    assert sorted(r[0] for r in Q.tables_to_fix(audit).collect()) == ["a", "c"]
    assert Q.has_columns(tables["a"], ["x"]) and not Q.has_columns(tables["a"], ["x", "y"])


def test_health_and_profile(spark, rows):
    full = spark.createDataFrame([(1, "a")], "k int, v string")
    tables = {"full": full, "empty": full.where("k > 5")}
    assert rows(Q.health(spark, tables, ["full", "empty", "gone"])) == [
        ("empty", 0, "EMPTY"), ("full", 1, "OK"), ("gone", None, "NOT_FOUND"),
    ]
    got = rows(Q.profile(spark, {"full": full}, {"bad": "unreadable"}))
    assert got == [
        ("bad", None, None, None, None, "unreadable"),
        ("full", 0, "k", "int", 1, None),
        ("full", 1, "v", "string", 1, None),
    ]


def test_key_checks(spark, rows):
    fact = spark.createDataFrame([("g1", 1), ("g1", 1), ("g2", 2), ("g3", None)], "g string, p int")
    dim = spark.createDataFrame([(1,)], "p int")
    assert rows(Q.unique_key(fact, ["g", "p"])) == [("g1", 1, 2)]
    assert rows(Q.orphan_keys(fact, "p", dim, "p")) == [(2,)]
    assert rows(Q.completeness(fact, "g", 2)) == [("g2", 1), ("g3", 1)]


def test_load_status(spark):
    target = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("c",), ("z",)], "k string")
    assert tuple(Q.load_status(target, done, ["k"]).first()) == (3, 2, 2)


def test_kmeans_steps_gives_equal_labels_for_every_layout(spark, rows):
    import random

    rng = random.Random(1)
    centres = [(0.0, 0.0), (8.0, 0.0), (0.0, 8.0), (9.0, 9.0)]
    data = [(i, *[c + rng.gauss(0, 2) for c in centres[i % 4]]) for i in range(400)]
    data += data[:10] + [(900, None, 1.0), (901, 1.0, None)]
    df = spark.createDataFrame(data, "id int, x double, y double")
    found = [rows(K.kmeans_steps(df.repartition(n), ["x", "y"], 4, "id")) for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 412
    labels = {r[0]: r[3] for r in found[0]}
    assert labels[900] is None and labels[901] is None
    assert {labels[i] for i in range(400)} == {0, 1, 2, 3}
    # Labels follow the order of the centres, and nearly all rows lie with their own group.
    middle = {c: [r for r in found[0] if r[3] == c] for c in range(4)}
    means = [tuple(sum(v) / len(v) for v in zip(*[r[1:3] for r in middle[c]])) for c in range(4)]
    assert means == sorted(means)
    arrays = df.dropna().selectExpr("id", "array(x, y) AS v")
    assert [(r[0], r[2]) for r in rows(K.kmeans_steps(arrays, "v", 4, "id"))] == [(r[0], r[3]) for r in found[0] if r[3] is not None]


def test_kmeans_steps_of_few_rows(spark, rows):
    two = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id int, x double")
    with pytest.warns(UserWarning, match="2 distinct"):
        assert rows(K.kmeans_steps(two, ["x"], 4, "id"), "id", "cluster") == [(1, 0), (2, 0), (3, 1)]
    with pytest.warns(UserWarning, match="0 distinct"):
        assert rows(K.kmeans_steps(two.limit(0), ["x"], 2, "id")) == []
    assert {r.cluster for r in K.kmeans_steps(two, ["x"], 1, "id").collect()} == {0}
    with pytest.raises(ValueError):
        K.kmeans_steps(two, ["x"], 0, "id")
