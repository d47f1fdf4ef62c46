"""Joins that split frequent keys: same rows as a plain join, no task with a whole frequent key."""

import pytest
from pyspark.sql import functions as F

from bindings import relational
from courtstats.operators import joins
from courtstats.operators.hot_keys import hot_join, hot_keys, task_rows

SF = "/root/testdata/sf0.01"


@pytest.fixture
def shuffled(spark):
    """Sixteen tasks a join, none merged, split or turned into a broadcast by Spark itself."""
    wanted = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def facts(spark):
    """60,000 rows: a third on key 7, a tenth without a key, the rest on 5,000 keys."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(60_000).select(key.alias("k"), "id")


def spread(df):
    found = sorted(r["rows"] for r in task_rows(df).collect())
    return found[-1] / found[len(found) // 2]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_of_a_plain_join(spark, shuffled, rows, how):
    big = facts(spark)
    other = spark.range(0, 9000, 2).selectExpr("id as k", "id * 10 as v").union(spark.sql("values (7L, 1L), (7L, 2L)"))
    hot = hot_keys(big, [["k"]])
    assert hot[("k",)]
    got = hot_join(big, other, ["k"], hot, how)
    plain = big.join(other, ["k"], how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_no_task_holds_a_frequent_key(spark, shuffled):
    big = facts(spark).where("k is not null")
    other = spark.range(5000).selectExpr("id as k", "id as v")
    hot = hot_keys(big, [["k"]])
    assert spread(big.join(other, "k")) > 4
    assert spread(hot_join(big, other, ["k"], hot)) < 2


def test_a_frequent_attacker_is_split(spark, shuffled):
    star = "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END"
    tables = relational.matchup_tables(spark, SF, star)
    assert spread(joins.matchup_join(*tables)) > 4
    assert spread(joins.matchup_join(*tables, split_hot=True)) < 2


def test_several_key_lists_take_one_pass(spark, shuffled):
    big = facts(spark).withColumn("even", F.col("id") % 2)
    hot = hot_keys(big, [["k"], ["even"], ["id"], ["k", "even"]])
    assert len(hot[("k",)]) == 2 and len(hot[("even",)]) == 2 and not hot[("id",)]
    assert len(hot[("k", "even")]) == 3  # key 7 on both sides, the missing key on odd ids only
    shares = sorted(hot[("even",)].values())
    assert shares[0] == pytest.approx(64, abs=4)


def test_small_and_odd_inputs(spark, rows):
    empty = spark.createDataFrame([], "k long, id long")
    hot = hot_keys(empty, [["k"]])
    assert hot == {("k",): {}}
    assert hot_join(empty, empty.select("k"), ["k"], hot).count() == 0
    with pytest.raises(ValueError):
        hot_join(empty, empty, ["k"], hot, "full")
    same = spark.createDataFrame([(1, "a")] * 50, "k long, t string")
    got = hot_join(same, spark.createDataFrame([(1, 2)], "k long, v int"), ["k"], hot_keys(same, [["k"]]))
    assert rows(got) == [(1, "a", 2)] * 50


def test_star_join_keeps_columns_and_rows(spark, rows):
    big = facts(spark)
    dims = [("k", spark.range(5000).selectExpr("id as key", "id * 2 as v"), "key", {"v": "v"})]
    split = joins.star_join(big, dims, split_hot=True)
    plain = joins.star_join(big, dims)
    assert split.columns == plain.columns == ["k", "id", "v"]
    assert rows(split) == rows(plain)
