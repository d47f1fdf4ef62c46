"""Steps whose rows are dealt by their number: a task's share stays as it is when a table grows."""

import pytest
from pyspark.sql import functions as F

from bindings import relational as R
from bindings.common import SCHEMAS
from courtstats.operators import dealing as D
from courtstats.operators import keysets as K


@pytest.fixture(autouse=True)
def small_tasks(monkeypatch):
    monkeypatch.setattr(D, "TASK_ROWS", 50)


def test_a_task_a_core_at_least_and_no_part_without_rows(spark):
    assert [D.parts_for(n) for n in (0, 1, 50, 51)] == [1, 1, 1, 2]
    assert D.dealt(spark.range(10), ["id"], 10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_group_bitmaps_are_gathered_by_as_many_tasks_as_the_rows_need(spark, rows):
    hot = spark.range(1_000).select(F.lit(1).alias("g"), F.lit(5).alias("k"))
    df = spark.range(2_000).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") % 700).cast("int").alias("k"))
    none = spark.createDataFrame([(None, 1), (2, None)], "g int, k int")
    df = df.unionByName(hot).unionByName(none)
    assert K.key_bitmaps(df, "k", ["g"]).rdd.getNumPartitions() == 61
    expected = df.groupBy("g").agg(F.count_distinct("k").alias("n"))
    assert rows(K.count_distinct_keys(df, ["g"], "k", "n"), "g", "n") == rows(expected, "g", "n")


@pytest.fixture
def given(spark, tmp_path):
    """Orders without lines, lines without orders, repeated and null keys."""
    made = {
        "orders": spark.range(400).selectExpr("if(id = 9, null, id div 2 * 2) o_orderkey", "id % 30 o_custkey"),
        "lineitem": spark.range(1_500).selectExpr(
            "if(id % 100 = 3, null, id % 350) l_orderkey", "id % 11 l_suppkey", "1 l_linenumber", "2D l_quantity"
        ),
        "customer": spark.range(29).selectExpr("id c_custkey", "concat('c', id) c_name", "cast(id % 5 as int) c_nationkey"),
        "supplier": spark.range(10).selectExpr("id s_suppkey", "concat('s', id) s_name", "cast(id % 4 as int) s_nationkey"),
        "nation": spark.range(5).selectExpr("cast(id as int) n_nationkey", "concat('n', id) n_name"),
    }
    for name, df in made.items():
        cols = {c.split()[0]: c.split()[1] for c in SCHEMAS[name].split(", ")}
        df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in cols.items()]).write.parquet(
            f"{tmp_path}/{name}.parquet"
        )
    return str(tmp_path)


def test_box_scores_are_made_by_as_many_tasks_as_the_lines_need(spark, given, rows):
    _, _, box_scores, _ = R.matchup_tables(spark, given)
    assert box_scores.rdd.getNumPartitions() == 30
    lines, orders, customer, supplier = (
        spark.read.parquet(f"{given}/{t}.parquet") for t in ("lineitem", "orders", "customer", "supplier")
    )
    games = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    off = games.join(customer, games.o_custkey == customer.c_custkey).selectExpr(
        "string(l_orderkey) game_id", "o_custkey player_id", "c_nationkey team_id"
    )
    defs = games.join(supplier, games.l_suppkey == supplier.s_suppkey).selectExpr(
        "string(l_orderkey) game_id", "-l_suppkey - 1 player_id", "s_nationkey team_id"
    )
    names = ["game_id", "player_id", "team_id"]
    assert rows(box_scores, *names) == rows(off.union(defs).distinct(), *names)
