"""Aggregation operators. All of them combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtstats.session import materialize


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(col).alias(name))


def sum_by(df: DataFrame, by: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Sums per group; ``cols`` maps source column to output name."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(name) for c, name in cols.items()])


def mean_by(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(col).alias(name))


def argmax_columns_of(cols: Sequence[str], order: Column, prefix: str = "") -> list[Column]:
    """One ``max_by`` per column, all taken from the row with the largest ``order``.

    ``order`` must be unique within a group; rows where it is NULL are skipped, so
    a condition can be folded into it. With numeric columns the buffers are
    fixed-width and Spark keeps a hash aggregate (a struct would force a sort).
    """
    return [F.max_by(c, order).alias(prefix + c) for c in cols]


def argmax_by(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Columns of the row with the largest order value per group."""
    return df.groupBy(*keys).agg(*argmax_columns_of(cols, F.col(order)))


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Frequency per value, ascending by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(col)


def pivot_mean(
    df: DataFrame,
    row: str,
    col: str,
    value: str,
    labels: Sequence[str],
    fill: float | None = None,
) -> DataFrame:
    """Mean of ``value`` per (row, label), one column per label.

    Conditional means need one aggregate and one shuffle; ``pivot`` takes two.
    """
    means = [F.avg(F.when(F.col(col) == label, F.col(value))) for label in labels]
    if fill is not None:
        means = [F.coalesce(m, F.lit(float(fill))) for m in means]
    return df.groupBy(row).agg(*[m.alias(label) for m, label in zip(means, labels)])


def having_min_rows(df: DataFrame, count_col: str, minimum: int) -> DataFrame:
    """Groups of an aggregate that hold at least ``minimum`` rows."""
    return df.where(F.col(count_col) >= minimum)


def min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def exact_median(df: DataFrame, col: str, name: str = "median", weight: str | None = None) -> DataFrame:
    """Exact median of a numeric column: one row, null for a column without values.

    ``weight`` names a column of whole numbers: how often a row counts.

    Values are counted, placed in ranges and stored. One row of totals per range tells which
    ranges hold the middle ranks; only their values are ranked, each range by itself. Nothing but the totals, a
    row per range, meets in one task.
    """
    values = (
        df.select(F.col(col).cast("double").alias("v"), (F.col(weight).cast("long") if weight else F.lit(1)).alias("w"))
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.sum("w").alias("c"))
    )
    placed = materialize(values.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    upto, everything = Window.orderBy("part"), Window.partitionBy()
    totals = placed.groupBy("part").agg(F.sum("c").alias("held")).select(
        "part",
        (F.sum("held").over(upto) - F.col("held")).alias("base"),
        F.col("held"),
        F.sum("held").over(everything).alias("total"),
    )
    first, last = F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")
    middle = totals.where((F.col("base") < last) & (F.col("base") + F.col("held") >= first))
    ranked = placed.join(middle, "part").withColumn(
        "rank", F.col("base") + F.sum("c").over(Window.partitionBy("part").orderBy("v"))
    )
    ends = [F.min(F.when(F.col("rank") >= end, F.col("v"))) for end in (first, last)]
    return ranked.agg(((ends[0] + ends[1]) / 2).alias(name))


def members(df: DataFrame, group: str, member: str) -> DataFrame:
    """Members of each group in long form, with the size of their group.

    The list stays spread over rows, so one large group does not end up in one task.
    """
    rows = df.select(group, member).distinct()
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    return rows.join(sizes, group)


def member_lists(df: DataFrame, group: str, member: str) -> DataFrame:
    """One row per group with its sorted members as text.

    The text of a group is one value, so it is for groups whose text a reader would read (teams in a
    cluster); :func:`members` is the form for groups of any size.
    """
    rows = df.select(group, member).distinct()
    return rows.groupBy(group).agg(
        F.array_join(F.sort_array(F.collect_list(member)), ", ").alias("members"),
        F.count(F.lit(1)).alias("size"),
    )


def pair_by_key(
    df: DataFrame, key: str, order: str, cols: Sequence[str], n: int = 2
) -> DataFrame:
    """Bundle the two rows of a key into one; other keys are marked incomplete.

    First and last row come from ``min_by`` and ``max_by``, so a key with very
    many rows is counted, not collected.
    """
    row = F.struct(*cols)
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by(row, order).alias("first"),
        F.max_by(row, order).alias("last"),
    )
    complete = F.col("rows") == n
    sides = [
        F.when(complete, F.col(side)[c]).alias(f"{c}_{i}")
        for i, side in ((1, "first"), (2, "last"))
        for c in cols
    ]
    return grouped.select(key, "rows", complete.alias("complete"), *sides)
