"""Exact values at ranks, for all groups at once and without sorting a group.

A histogram per group tells in which bin a rank lies; that bin alone is divided again, between its own smallest
and largest value, until it holds one value or few enough rows to rank them. Bins are equal in width and, every
second pass, in magnitude, so values of all sizes take few passes too. Each pass is an aggregate of
``bins`` counts per group and wanted rank, so a group with most of the rows costs no task more than its share.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from courtstats.session import materialize

#: Bins of a pass, and rows of a bin that are ranked in one task.
BINS, BIN_ROWS = 1024, 1_000_000


def _on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs], F.lit(True))


def values_at_ranks(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    ranks: Callable[[Column], Column],
    bins: int = BINS,
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """(by..., n, place, rank, value): for every group the values at the ranks that ``ranks`` makes of its size.

    ``ranks`` maps the number of rows to an array of whole numbers from 1 to that number; ``place`` is a rank's index in it. Rows without
    a finite value are left out, groups without such rows have none. Null groups are groups like any other.
    """
    group = [f"__g{i}" for i in range(len(by))]
    value = F.col(col).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    rows = df.where(finite).select(*[F.col(b).alias(g) for b, g in zip(by, group)], value.alias("__v"))
    sizes = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high")
    )
    wanted = sizes.select(*group, "n", "low", "high", F.posexplode(ranks(F.col("n"))).alias("place", "rank"))
    wanted = materialize(wanted.withColumns({"before": F.lit(0).cast("long"), "held": F.col("n")}))
    is_open = (F.col("low") < F.col("high")) & (F.col("held") > bin_rows)
    scales = itertools.cycle([lambda v: v / 2, _magnitude])  # halves, so that not even the widest range overflows
    while wanted.where(is_open).limit(1).count():
        binned, scale = _inside(rows, wanted.where(is_open), group), next(scales)
        width = scale(F.col("high")) - scale(F.col("low"))
        share = F.when(width > 0, (scale(F.col("__v")) - scale(F.col("low"))) / width).otherwise(0.0)
        bin_ = F.greatest(F.least(F.floor(share * bins), F.lit(bins - 1).cast("long")), F.lit(0).cast("long"))
        counts = binned.withColumn("bin", bin_).groupBy(*group, "low", "high", "bin").agg(
            F.count(F.lit(1)).alias("rows"), F.min("__v").alias("bin_low"), F.max("__v").alias("bin_high")
        )
        wanted = materialize(_narrow(wanted, counts, group, is_open, "bin", ("bin_low", "bin_high")))
    few = F.col("low") < F.col("high")
    counts = _inside(rows, wanted.where(few), group).groupBy(*group, "low", "high", "__v").agg(F.count(F.lit(1)).alias("rows"))
    found = _narrow(wanted, counts, group, few, "__v", ("__v", "__v"))
    return found.select(*[F.col(g).alias(b) for g, b in zip(group, by)], "n", "place", "rank", F.col("low").alias("value"))


def _magnitude(v: Column) -> Column:
    """Grows with v, by 1 each time a positive number doubles; the smallest number has a magnitude of 26."""
    size = F.log2(F.abs(v)) + 1100
    return F.when(v == 0, 0.0).when(v > 0, size).otherwise(-size)


def _inside(rows: DataFrame, wanted: DataFrame, group: list[str]) -> DataFrame:
    """The rows within the wanted bins of their group, with the bin's ends. Bins of a group don't overlap."""
    ends = wanted.select(*[F.col(g).alias(f"w{g}") for g in group], "low", "high").distinct()
    inside = (F.col("__v") >= F.col("low")) & (F.col("__v") <= F.col("high"))
    return rows.join(ends, _on(rows, ends, [(g, f"w{g}") for g in group]) & inside).select(*group, "low", "high", "__v")


def _narrow(wanted: DataFrame, counts: DataFrame, group: list[str], chosen: Column, order: str, ends: tuple[str, str]) -> DataFrame:
    """Chosen ranks move to the part of their bin that holds them; the others stay."""
    names = [*group, "low", "high"]
    upto = F.sum("rows").over(W.partitionBy(*names).orderBy(order))
    parts = counts.withColumn("upto", upto).select(
        *[F.col(c).alias(f"p{c}") for c in names], "upto", "rows", F.col(ends[0]).alias("part_low"), F.col(ends[1]).alias("part_high")
    )
    moving = wanted.where(chosen)
    hit = (moving["rank"] > moving["before"] + parts["upto"] - parts["rows"]) & (
        moving["rank"] <= moving["before"] + parts["upto"]
    )
    moved = moving.join(parts, _on(moving, parts, [(c, f"p{c}") for c in names]) & hit).select(
        *group,
        "n",
        F.col("part_low").alias("low"),
        F.col("part_high").alias("high"),
        "place",
        "rank",
        (F.col("before") + F.col("upto") - F.col("rows")).alias("before"),
        F.col("rows").alias("held"),
    )
    return wanted.where(~chosen).unionByName(moved)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], col: str, shares: Sequence[float], bins: int = BINS, bin_rows: int = BIN_ROWS
) -> DataFrame:
    """(by..., share, value): the smallest value that at least a ``share`` of the group's rows don't exceed."""

    def ranks(n: Column) -> Column:
        return F.array(*[F.greatest(F.ceil(F.lit(float(s)) * n), F.lit(1).cast("long")) for s in shares])

    at = values_at_ranks(df, by, col, ranks, bins, bin_rows)
    share = F.array(*[F.lit(float(s)) for s in shares])[F.col("place")]
    return at.select(*by, share.alias("share"), "value")


def exact_medians(
    df: DataFrame, by: Sequence[str], col: str, name: str = "median", bins: int = BINS, bin_rows: int = BIN_ROWS
) -> DataFrame:
    """(by..., name): the median of every group, the mean of both middle values for an even number of rows."""

    def ranks(n: Column) -> Column:
        return F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1)

    at = values_at_ranks(df, by, col, ranks, bins, bin_rows)
    return at.groupBy(*by).agg((F.sum(F.col("value") / 2)).alias(name))
