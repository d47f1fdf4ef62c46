"""Sorting and top-k operators. Every order carries its own tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def best_and_worst(ranking: DataFrame, value: str, tie: str, k: int = 5) -> DataFrame:
    """The k highest and the k lowest rows, labelled and numbered from each end."""

    def end(label: str, first: Column, second: Column) -> DataFrame:
        # k rows at most reach the numbering.
        rows = ranking.orderBy(first, second).limit(k)
        place = F.expr(
            f"row_number() over (order by `{value}` {'desc' if label == 'best' else 'asc'}, "
            f"`{tie}` {'asc' if label == 'best' else 'desc'})"
        )
        return rows.select(F.lit(label).alias("side"), place.alias("place"), *ranking.columns)

    best = end("best", F.col(value).desc(), F.col(tie).asc())
    worst = end("worst", F.col(value).asc(), F.col(tie).desc())
    return best.unionByName(worst)


def sort_by(df: DataFrame, col: str, tie: str, descending: bool = True) -> DataFrame:
    """Sorted on one column with NULLs last."""
    first = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    return df.orderBy(first, F.col(tie).asc())


def sample_head(df: DataFrame, k: int = 5) -> DataFrame:
    """Preview rows."""
    return df.limit(k)
