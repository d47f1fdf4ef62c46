"""Exact sets of whole-number keys as bitmaps.

A bitmap holds which of 32,768 neighbouring keys occur: 4 KB a range, whatever the number of rows. Tasks build
them from their own rows and only bitmaps are shuffled, at most one per task, group and range, so counts, differences
and load status of dense keys (games, orders, players) never move a single key. Where keys are sparse (far fewer than a
hundred per range) the plain operators move less. Null keys are in no set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats.operators.dealing import dealt

#: Keys per bitmap, as Spark's bitmap functions define it.
RANGE = 32_768


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., range, bits): the keys of every group, a row per range that holds one."""
    number = F.col(key).cast("long")
    rows = df.where(number.isNotNull()).select(
        *by, F.bitmap_bucket_number(number).alias("range"), F.bitmap_bit_position(number).alias("__bit")
    )
    if by:
        # A range that very many rows fall in is gathered per reading task first, so none of its rows meet in one task.
        size, shares = df.count(), [*by, "range", "__task"]
        dealt_rows = dealt(rows.withColumn("__task", F.spark_partition_id()), shares, size)
        parts = dealt_rows.groupBy(*shares).agg(F.bitmap_construct_agg("__bit").alias("bits"))
        return dealt(parts.drop("__task"), [*by, "range"], size).groupBy(*by, "range").agg(F.bitmap_or_agg("bits").alias("bits"))
    return rows.groupBy(*by, "range").agg(F.bitmap_construct_agg("__bit").alias("bits"))


def count_distinct_keys(df: DataFrame, by: Sequence[str], key: str, name: str) -> DataFrame:
    """Distinct keys per group that has one, exactly; without groups one row, 0 for no keys."""
    counts = key_bitmaps(df, key, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
    return counts if by else counts.select(F.coalesce(name, F.lit(0).cast("long")).alias(name))


def _beside(target: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """(range, target_bits, done_bits, either_bits) of every range that either holds."""
    both = key_bitmaps(target, key).withColumn("side", F.lit("target")).unionByName(
        key_bitmaps(done, key).withColumn("side", F.lit("done"))
    )
    sides = [F.bitmap_or_agg(F.when(F.col("side") == s, F.col("bits"))).alias(f"{s}_bits") for s in ("target", "done")]
    return both.groupBy("range").agg(*sides, F.bitmap_or_agg("bits").alias("either_bits"))


def set_sizes(target: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of target and done, those in both, those still to do, and done ones that aren't in target."""
    counts = _beside(target, done, key).agg(
        *[F.coalesce(F.sum(F.bitmap_count(f"{s}_bits")), F.lit(0)).alias(s) for s in ("target", "done", "either")]
    )
    t, d, e = F.col("target"), F.col("done"), F.col("either")
    return counts.select("target", "done", (t + d - e).alias("both"), (e - d).alias("to_do"), (e - t).alias("surplus"))


def key_difference(target: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys of target that done lacks, each once. Only ranges that differ are taken apart, byte by byte."""
    ranges = _beside(target, done, key).where(F.bitmap_count("either_bits") > F.bitmap_count("done_bits"))
    bytes_ = ranges.select("range", "target_bits", "done_bits", F.explode(F.sequence(F.lit(0), F.lit(RANGE // 8 - 1))).alias("byte"))

    def value(bits: str) -> Column:
        return F.conv(F.hex(F.substring(F.col(bits), F.col("byte") + 1, F.lit(1))), 16, 10).cast("int")

    left = bytes_.select("range", "byte", value("target_bits").bitwiseAND(F.bitwise_not(value("done_bits"))).alias("left"))
    bits = left.where(F.col("left") != 0).select(
        "range", "byte", "left", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")
    )
    place = F.col("byte").cast("long") * 8 + F.col("bit")
    first = F.col("range") * RANGE
    # Ranges above zero start at 1, 32,769, ...; the others count down from their multiple.
    number = F.when(F.col("range") > 0, first - RANGE + 1 + place).otherwise(first - place)
    return bits.where(F.getbit(F.col("left"), F.col("bit")) == 1).select(number.alias(key))
