"""Joins on keys of which a few hold a large part of the rows.

One aggregate sketches the frequent keys of a fact table, for all its join keys at once. A join then gives the rows of
a frequent key numbers, as many as its rows need, and only that key's rows on the other side are repeated once
per number. All other keys join as they are, so little is copied and no task gets a whole frequent key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: A key is frequent if it holds more than one in so many of a task's rows, and is split into shares of half that.
SHARES = 4
#: Most keys that the sketch of one key list may track (a limit of the aggregate).
TRACK_LIMIT = 1_000_000

HotKeys = Mapping[tuple[str, ...], Mapping[int, int]]


def key_code(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, key_lists: Sequence[Sequence[str]], parts: int | None = None) -> HotKeys:
    """Codes of the frequent keys of every key list, each with the number of shares to split it into.

    ``parts``: tasks of the join, by default the shuffle partitions. The result has at most ``2 * SHARES * parts`` keys a
    list, however large the table. One pass over the key columns; counts are those of a frequent-items sketch, whose
    error is below half of what makes a key frequent while ``32 * SHARES * parts`` keys may be tracked. A wrong
    count costs balance, never rows. Null keys count like any other.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    track = min(TRACK_LIMIT, 32 * SHARES * parts)
    most = min(track, 2 * SHARES * parts)
    lists = [tuple(keys) for keys in key_lists]
    coded = df.select(*[key_code(keys).alias(f"c{i}") for i, keys in enumerate(lists)])
    tops = [F.expr(f"approx_top_k(c{i}, {most}, {track})").alias(f"t{i}") for i in range(len(lists))]
    row = coded.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    share = max(1.0, row["n"] / (SHARES * parts))
    return {
        keys: {t["item"]: math.ceil(2 * t["count"] / share) for t in row[f"t{i}"] or [] if t["count"] > share}
        for i, keys in enumerate(lists)
    }


def hot_join(big: DataFrame, other: DataFrame, keys: Sequence[str], hot: HotKeys, how: str = "inner") -> DataFrame:
    """``big`` joined to ``other`` on columns of one name, frequent keys of ``big`` split.

    ``how``: inner, left, left_semi or left_anti; the other kinds would repeat unmatched rows of ``other``. The share of
    a row follows from its columns, so a task that runs again deals rows alike; rows equal in all columns stay
    together. Columns come as in a join on names: keys, then the rest of ``big``, then of ``other``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a join of kind {how!r} can't repeat rows of its right side")
    shares = hot[tuple(keys)]
    if not shares:
        return big.join(other, list(keys), how)
    spark = big.sparkSession
    # Bounded by the number of tasks (see hot_keys), so it may go to all of them.
    table = F.broadcast(spark.createDataFrame(sorted(shares.items()), "__code long, __shares int"))

    def coded(df: DataFrame) -> DataFrame:
        return df.withColumn("__code", key_code(keys)).join(table, "__code", "left").drop("__code")

    rest = [f.name for f in big.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    dealt = F.pmod(F.xxhash64(*rest, F.lit("share")), F.col("__shares")).cast("int")
    left = coded(big).withColumn("__share", F.coalesce(dealt, F.lit(0))).drop("__shares")
    last = F.coalesce(F.col("__shares"), F.lit(1)) - 1
    right = coded(other).withColumn("__share", F.explode(F.sequence(F.lit(0), last))).drop("__shares")
    return left.join(right, [*keys, "__share"], how).drop("__share")


def task_rows(df: DataFrame) -> DataFrame:
    """Rows in every task of the last step of ``df``: (part, rows)."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("rows"))
