"""Contiguous shards of near-equal bytes from a distributed prefix sum (built-in functions only).

Rows are range-partitioned by id and stored with the number of their partition.
One row of totals per partition gives each partition its base; within a partition a
window adds the rows before. No step sees more than one partition's rows, and the only
global window runs over the totals (a row per partition). A shard is cut where the
prefix sum passes an equal share of all bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import query, read

#: Bytes counted for every row besides its text: the 64-bit offset of an index file.
ROW_OVERHEAD = 8


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, str], ties: list[Column] = ()) -> DataFrame:
    """Adds ``name`` = sum of a column over all earlier rows, for each name: column of ``sums``.

    ``name_total`` is the sum over all rows. Rows are ordered by ``order`` (nulls first), then by ``ties``. Equal rows are dealt out
    by a seeded random number, so a key that holds most rows still spreads; as they are equal,
    their order among each other doesn't change the result. An empty table stays empty.
    """
    keys = [f"_k{i}" for i in range(len(order) + len(ties))]
    cols = [F.col(c) for c in order] + list(ties)
    keyed = df.select("*", *[c.alias(k) for c, k in zip(cols, keys)], F.rand(7).alias("_tie"))
    by = [*keys, "_tie"]
    placed = materialize(
        keyed.repartitionByRange(*by).withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    )
    # One row per partition: the only rows that meet in one task.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bases = totals.select(
        "_part",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(everything).alias(f"{n}_total") for n in sums],
    )
    inside = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    out = local.join(bases, "_part")
    return out.select(
        *df.columns,
        *[(F.col(n) + F.col(f"_base_{n}")).alias(n) for n in sums],
        *[f"{n}_total" for n in sums],
    )


def shard_by_bytes(
    df: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Shard and place in the shard of every row; shards follow the order of the key.

    Returns key, size (UTF-8 bytes + 8), text_crc32, shard (0 to ``shards`` - 1) and slot
    (gapless from 0 within the shard). A row belongs to the shard in whose equal share of the
    bytes its middle byte lies, so shards differ by less than the longest row. Null text: size
    8, checksum 0. Null keys come first; ties are ordered by checksum and size. Other columns
    are dropped. Fewer rows than shards: some shards stay empty. No rows: no rows.
    """
    sized = df.select(
        F.col(key).alias(key),
        (text_bytes(F.col(text)) + ROW_OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(1).cast("long").alias("_one"),
    )
    ties = [F.col("text_crc32"), F.col("size")]
    rows = prefix_sums(sized, [key], {"_start": "size", "_row": "_one"}, ties)
    middle = rows.withColumn(
        # Exact integers: double the middle byte times shards over double the total.
        "shard",
        F.least(
            F.lit(shards - 1).cast("long"),
            F.expr(f"((2 * _start + size) * {shards}) div (2 * _start_total)"),
        ).cast("int"),
    )
    first = middle.groupBy("shard").agg(F.min("_row").alias("_first"))
    return middle.join(F.broadcast(first), "shard").select(
        key, "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


@query("op7_shard_by_bytes")
def op7_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of near-equal bytes."""
    cut = shard_by_bytes(read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
