"""Clustering operators."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats.functions.columns import argmax_name, argmin_name, label_if
from courtstats.session import materialize


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """z-scores with the population deviation; a constant column is only centred.

    Means and deviations are one row and enter as a scalar subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
        ).alias("stats")
    )
    out = df.withColumn("__stats", stats.scalar())
    spread = [F.col(f"__stats.s{i}") for i in range(len(cols))]
    return out.withColumns(
        {
            c + suffix: (F.col(c) - F.col(f"__stats.m{i}"))
            / F.when(spread[i] > 0, spread[i]).otherwise(F.lit(1.0))
            for i, c in enumerate(cols)
        }
    ).drop("__stats")


def kmeans(
    df: DataFrame,
    features: Sequence[str] | str,
    k: int,
    seed: int = 42,
    name: str = "cluster",
    max_iter: int = 300,
) -> DataFrame:
    """Cluster label per row, numbered by the order of the centres.

    ``features`` is a list of numeric columns or the name of one array column.
    Labels come from the distributed k-means of Spark ML. With fewer distinct rows than ``k``, each
    distinct row is its own cluster, and a warning says how many there are.
    """
    if k < 1:
        raise ValueError(f"k must be positive, not {k}")
    if isinstance(features, str):
        with_vector = df.withColumn("__features", array_to_vector(F.col(features).cast("array<double>")))
    else:
        with_vector = VectorAssembler(inputCols=list(features), outputCol="__features").transform(df)
    # Spark's k-means fails on fewer places than clusters, so they are counted, exactly.
    columns = [features] if isinstance(features, str) else list(features)
    places = with_vector.select(*columns).distinct().limit(k).count()
    if places < k:
        warnings.warn(f"only {places} distinct rows for {k} clusters", stacklevel=2)
        k = places
    if k < 2:
        return with_vector.withColumn(name, F.lit(0)).drop("__features")
    # Five seeding rounds gather far more than k candidates, so k centres always remain.
    model = KMeans(
        featuresCol="__features",
        predictionCol="__label",
        k=k,
        seed=seed,
        initSteps=5,
        maxIter=max_iter,
        tol=1e-4,
    ).fit(with_vector)
    centres = [tuple(round(float(v), 9) for v in c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    number = F.create_map(*[F.lit(v) for i, old in enumerate(order) for v in (old, i)])
    return (
        model.transform(with_vector)
        .withColumn(name, number[F.col("__label")])
        .drop("__features", "__label")
    )


#: Rows among which the first centres of :func:`kmeans_steps` are chosen.
SEED_ROWS = 1000
#: Decimals to which distances and centres are rounded before they are compared.
DECIMALS = 9


def _distance(features: Column, centre: Column) -> Column:
    squares = F.zip_with(features, centre, lambda a, b: (a - b) * (a - b))
    return F.round(F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)), DECIMALS)


def _nearest(features: Column, centres: list[list[float]]) -> Column:
    """Number of the nearest centre, the smaller one of a tie."""
    known = F.array(*[F.lit(c) for c in centres])
    return F.array_min(F.transform(known, lambda c, i: F.struct(_distance(features, c).alias("d"), i.alias("i"))))["i"]


def _first_centres(rows: DataFrame, k: int) -> list[list[float]]:
    """The row of the smallest hash, then always the row furthest from all centres so far, among the sample."""
    taken = rows.orderBy("__hash", "__features").limit(SEED_ROWS).select("__features").toArrow()
    points = np.array(taken["__features"].to_pylist(), np.float64).reshape(len(taken), -1 if len(taken) else 0)
    centres, away = [], np.full(len(points), np.inf)
    while len(centres) < min(k, len(points)) and away.max() > 0:
        centres.append(points[int(np.argmax(away))].tolist())  # the first of a tie has the smaller hash
        away = np.minimum(away, np.round(np.sqrt(((points - centres[-1]) ** 2).sum(1)), DECIMALS))
    return centres


def kmeans_steps(
    df: DataFrame, features: Sequence[str] | str, k: int, key: str, steps: int = 25, name: str = "cluster"
) -> DataFrame:
    """Cluster label per row by rules that give the same labels for every layout of the rows.

    First centres: among the ``SEED_ROWS`` rows of the smallest md5 of the key, the first, then the one furthest from those
    chosen. Then up to ``steps`` times every row joins its nearest centre and centres move to the
    mean of their rows; a centre that no row joins stays. Distances and means are rounded to ``DECIMALS``, ties go to the
    earlier centre. Labels number the centres in their order. Each step is one aggregate of k rows; it ends when no centre
    moves. Rows with a null feature get no label and count nowhere. With fewer distinct rows in the sample than ``k``
    there are fewer clusters, and a warning says how many.
    """
    if k < 1:
        raise ValueError(f"k must be positive, not {k}")
    listed = F.col(features) if isinstance(features, str) else F.array(*features)
    marked = df.withColumns({"__features": listed.cast("array<double>"), "__hash": F.md5(F.col(key).cast("string"))})
    rows = materialize(marked)
    full = rows.where(F.col("__features").isNotNull() & F.forall("__features", lambda v: v.isNotNull()))
    centres = _first_centres(full, k)
    if len(centres) < k:
        warnings.warn(f"only {len(centres)} distinct rows for {k} clusters", stacklevel=2)
    if not centres:
        return rows.withColumn(name, F.lit(None).cast("int")).drop("__features", "__hash")
    width = range(len(centres[0]))
    for _ in range(steps):
        joined = full.select(_nearest(F.col("__features"), centres).alias("c"), "__features").groupBy("c")
        means = joined.agg(*[F.round(F.avg(F.col("__features")[i]), DECIMALS).alias(f"m{i}") for i in width])
        moved = list(centres)
        for row in means.collect():
            moved[row["c"]] = [row[f"m{i}"] + 0.0 for i in width]
        if moved == centres:
            break
        centres = moved
    whole = F.col("__features").isNotNull() & F.forall("__features", lambda v: v.isNotNull())
    label = F.when(whole, _nearest(F.col("__features"), sorted(centres)))
    return rows.withColumn(name, label).drop("__features", "__hash")


def cluster_profile(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Cluster centres in original units, with size and the best and worst feature."""
    profile = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(c) for c in features]
    )
    return profile.withColumns({"best": argmax_name(features), "worst": argmin_name(features)})


def cluster_complexity(
    df: DataFrame, cluster: str, degree: str = "Best_Degree", below: float = 1.5
) -> DataFrame:
    """Mean degree per cluster and the label that follows from it."""
    means = df.groupBy(cluster).agg(F.avg(degree).alias("avg_degree"))
    return means.withColumn(
        "complexity", label_if(F.col("avg_degree"), below, "Linear", "Complex")
    )
