"""Window operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from courtstats.session import materialize


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in a stated order.

    Spark limits each key to one row per task before the shuffle
    (WindowGroupLimit), so a hot key does not travel whole.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


#: Pieces a key is cut into at a time: every row of a large key is compared with that many cuts.
FAN_OUT = 64


def pieces(df: DataFrame, keys: Sequence[str], order: str, rows: int, name: str = "__piece") -> DataFrame:
    """Adds the place of the piece a row lies in: keys with more than ``rows`` rows are cut along ``order``.

    Cuts are quantiles of the order values, from Spark's mergeable sketch over the rows of the large keys alone,
    so sparse, dense or lumpy orders (timestamps) give pieces of about ``rows`` rows. Keys that need more than
    ``FAN_OUT`` pieces are cut again, piece by piece; a place is an array with a number per cut, so places sort like their rows. Rows of
    equal order values share a piece. Large keys number at most a ``rows``-th of all rows, and only they meet the rows.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
    named = {k: f"__on_{k}" for k in keys}
    large = materialize(counts.withColumnsRenamed(named))
    most = large.agg(F.max("__n")).first()[0]
    if most is None:
        return df.withColumn(name, F.array(F.lit(0)))

    def on(right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [df[k].eqNullSafe(right[named[k]]) for k in keys], F.lit(True))

    needed = -(-most // rows)
    parts = min(needed, FAN_OUT)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = (
        df.join(large, on(large), "left_semi")
        .groupBy(*keys)
        .agg(F.array_distinct(F.percentile_approx(order, shares, 100 * parts)).alias("__cuts"))
        .withColumnsRenamed(named)
    )
    placed = df.join(cuts, on(cuts), "left")
    piece = F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col(order))), F.lit(0))
    place = F.array(F.when(F.col("__cuts").isNull(), 0).otherwise(piece))
    placed = placed.withColumn(name, place).select(*df.columns, name)
    if needed == parts:
        return placed
    deeper = pieces(placed, [*keys, name], order, 2 * rows, f"{name}_")
    return deeper.withColumn(name, F.concat(name, f"{name}_")).drop(f"{name}_")


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    order: str,
    chunk: int = 1_000_000,
) -> DataFrame:
    """Carry the last non-null value of each column forward within its key.

    ``order`` is a number, date or timestamp that is unique within a key. A key of more than ``chunk`` rows is
    cut into pieces of about that many: rows are filled inside their piece, and one
    row per piece passes its last value on to the next. A key of any size is
    thus sorted in pieces, and only its piece summaries meet in one task. Window,
    summary and join share the struct (keys, piece): the rows are shuffled once,
    and a NULL key meets itself.
    """
    chunked = pieces(df, keys, order, chunk).withColumn("__part", F.struct(*keys, "__piece"))
    inside = W.partitionBy("__part").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = chunked.withColumns({f"__{c}": F.last(c, ignorenulls=True).over(inside) for c in cols})

    earlier = (
        W.partitionBy(*[f"__part.{k}" for k in keys])
        .orderBy("__part.__piece")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    carried = (
        chunked.groupBy("__part")
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols])
        .select("__part", *[F.last(c, ignorenulls=True).over(earlier).alias(f"__in_{c}") for c in cols])
    )
    filled = {c: F.coalesce(F.col(f"__{c}"), F.col(f"__in_{c}")) for c in cols}
    return local.join(carried, "__part").withColumns(filled).select(*df.columns)


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    name: str = "rank",
    size_name: str | None = None,
) -> DataFrame:
    """1-based position of each row in its group, in the order of ``md5(key)``.

    The order is split by the leading hex digits of the hash: rows are ranked
    inside (group, digits) and shifted by the number of rows in earlier digits.
    A group that holds most of the table is ranked by 256 tasks, not by one.
    ``size_name`` adds the group's row count, from the same small frame.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    hashed = df.withColumn("__hash", digest).withColumn(
        "__part", F.struct(*by, F.substring("__hash", 1, 2).alias("__digits"))
    )
    ranked = hashed.withColumn(
        "__local", F.row_number().over(W.partitionBy("__part").orderBy("__hash", *key))
    )
    sizes = hashed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    whole = W.partitionBy(*([f"__part.{c}" for c in by] or [F.lit(0)]))
    earlier = whole.orderBy("__part.__digits").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part",
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__size").over(whole).alias("__group_size"),
    )
    extra = [F.col("__group_size").alias(size_name)] if size_name else []
    return (
        ranked.join(offsets, "__part")
        .withColumn(name, F.col("__local") + F.col("__before"))
        .select(*df.columns, name, *extra)
    )
