"""Bitmap key sets and exact quantiles against plain Python, with awkward values."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from courtstats.operators import keysets as K
from courtstats.operators import quantiles as N


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v, i % 3 if i % 5 else None) for i, v in enumerate(values)], f"{name} long, g int").repartition(4)


EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 65537, 2**40, -(2**40), 2**62]


def test_sets_equal_python_sets(spark, rows):
    rng = random.Random(1)
    target = EDGES + [rng.randint(-200_000, 200_000) for _ in range(3000)] + [None, None, 5, 5]
    done = EDGES[::2] + [rng.choice(target) for _ in range(1500)] + [7_000_000, None]
    t, d = {v for v in target if v is not None}, {v for v in done if v is not None}
    tf, df = keys(spark, target), keys(spark, done)
    sizes = rows(K.set_sizes(tf, df, "k"))
    assert sizes == [(len(t), len(d), len(t & d), len(t - d), len(d - t))]
    assert sorted(r[0] for r in rows(K.key_difference(tf, df, "k"))) == sorted(t - d)
    assert sorted(r[0] for r in rows(K.key_difference(df, tf, "k"))) == sorted(d - t)
    assert rows(K.count_distinct_keys(tf, [], "k", "n")) == [(len(t),)]
    groups = {}
    for i, v in enumerate(target):
        if v is not None:
            groups.setdefault(i % 3 if i % 5 else None, set()).add(v)
    expected = sorted([(g, len(s)) for g, s in groups.items()], key=repr)
    assert rows(K.count_distinct_keys(tf, ["g"], "k", "n")) == expected


def test_empty_sets(spark, rows):
    none, some = keys(spark, [None]), keys(spark, [3, 4])
    assert rows(K.set_sizes(none, none, "k")) == [(0, 0, 0, 0, 0)]
    assert rows(K.set_sizes(none, some, "k")) == [(0, 2, 0, 0, 2)]
    assert rows(K.key_difference(none, some, "k")) == [] and rows(K.key_difference(some, none, "k")) == [(3,), (4,)]
    assert rows(K.count_distinct_keys(none, [], "k", "n")) == [(0,)]
    assert rows(K.count_distinct_keys(none, ["g"], "k", "n")) == []


def test_only_bitmaps_are_shuffled(spark):
    """A task sends a row per range, not one per key."""
    df = spark.range(0, 200_000, 1, 4).withColumnRenamed("id", "k")
    bitmaps = K.key_bitmaps(df, "k")
    plan = bitmaps._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") > plan.index("Exchange")
    assert bitmaps.count() == 8  # ranges of 32,768 keys, the key 0 in one of its own


def expected_quantiles(values, shares):
    ordered = sorted(values)
    return [ordered[max(math.ceil(s * len(ordered)), 1) - 1] for s in shares]


@pytest.mark.parametrize("bins,bin_rows", [(1024, 1_000_000), (64, 3)])
def test_quantiles_of_awkward_groups(spark, rows, bins, bin_rows):
    rng = random.Random(2)
    groups = {
        "even": [rng.gauss(0, 1) for _ in range(400)],
        "skew": [math.exp(rng.gauss(0, 9)) for _ in range(300)],
        "same": [4.5] * 200,
        "few": [1.0, 1.0, 2.0],
        "one": [-7.25],
        "wide": [-1.7e308, 1.7e308, 0.0, 1e-300, 5e-324, -1e-300],
        "ties": [float(rng.randint(0, 3)) for _ in range(500)],
        None: [float(i) for i in range(50)],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs]
    data += [("even", None), ("even", math.nan), ("few", math.inf), ("gone", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = rows(N.exact_quantiles(df, ["g"], "v", shares, bins, bin_rows))
    expected = [(g, s, v) for g, vs in groups.items() for s, v in zip(shares, expected_quantiles(vs, shares))]
    assert got == sorted(expected, key=repr)
    medians = {r[0]: r[1] for r in rows(N.exact_medians(df, ["g"], "v", "m", bins, bin_rows))}
    assert medians.keys() == groups.keys()
    for g, vs in groups.items():
        assert medians[g] == pytest.approx(statistics.median(vs), rel=1e-12)


def test_quantiles_of_the_whole_table_and_of_none(spark, rows):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    assert rows(N.exact_quantiles(df, [], "v", [0.5, 0.9], 8, 10)) == [(0.5, 500.0), (0.9, 900.0)]
    assert rows(N.exact_medians(df, [], "v", "m")) == [(500.5,)]
    assert rows(N.exact_quantiles(df.limit(0), [], "v", [0.5])) == []
