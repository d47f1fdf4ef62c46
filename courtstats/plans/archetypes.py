"""Team archetypes: clusters of situational profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from courtstats.operators.cluster import cluster_complexity, cluster_profile, kmeans_steps, standardize
from courtstats.operators.joins import feature_join
from courtstats.plans.closing import TEAM, situational_matrix
from courtstats.schemas import BEST_FIT_DDL, SITUATION_EDGES, SITUATION_LABELS
from courtstats.sources.tables import scan_csv, write_csv


def _clustered(features: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    scaled = standardize(features, cols)
    return kmeans_steps(scaled, [c + "_z" for c in cols], k, TEAM).drop(*[c + "_z" for c in cols])


def team_archetypes(
    points: DataFrame,
    k: int = 5,
    edges: Sequence[float] = SITUATION_EDGES,
    labels: Sequence[str] = SITUATION_LABELS,
) -> DataFrame:
    """Situational features (against the cubic league curve) and a cluster per team."""
    features = situational_matrix(points, 3, edges, labels, fill=0.0)
    return _clustered(features, list(labels), k)


def team_archetypes_advanced(
    points: DataFrame,
    best_fits: DataFrame,
    k: int = 6,
    edges: Sequence[float] = SITUATION_EDGES,
    labels: Sequence[str] = SITUATION_LABELS,
) -> DataFrame:
    """Situational features (against the linear league fit), best degree, and a cluster per team."""
    features = situational_matrix(points, 1, edges, labels, fill=0.0)
    joined = feature_join(features, best_fits, TEAM, ["Best_Degree"])
    return _clustered(joined, [*labels, "Best_Degree"], k)


def archetype_profiles(
    clustered: DataFrame, labels: Sequence[str] = SITUATION_LABELS
) -> DataFrame:
    """Mean features per cluster in points, its size, and its best and worst situation."""
    return cluster_profile(clustered, "cluster", list(labels))


def archetype_profiles_advanced(
    clustered: DataFrame, labels: Sequence[str] = SITUATION_LABELS
) -> DataFrame:
    """Like :func:`archetype_profiles`, with mean degree and Linear/Complex label."""
    return archetype_profiles(clustered, labels).join(
        cluster_complexity(clustered, "cluster"), "cluster"
    )


def save_best_fits(best_fits: DataFrame, path: str) -> None:
    """Best fits as CSV, the hand-over between the two jobs."""
    write_csv(best_fits, path)


def read_best_fits(spark: SparkSession, path: str) -> DataFrame:
    """Team and best degree from a saved CSV."""
    return scan_csv(spark, path, BEST_FIT_DDL, [TEAM, "Best_Degree"])
