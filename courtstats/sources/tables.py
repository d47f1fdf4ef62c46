"""Table and file sources and sinks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtstats.schemas import registry
from courtstats.session import drop_folder, holds_data, path_exists, read_note, shared_folder, write_note

_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _qualified(name: str, database: str | None) -> str:
    for part in (name, database or "default"):
        if not _IDENTIFIER.match(part):
            raise ValueError(f"not a table name: {part!r}")
    return f"{database}.{name}" if database else name


def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or a Parquet path when the name holds a slash."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def scan_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A SQL query over catalog tables and the given frames."""
    return spark.sql(sql, **tables)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read by many tasks, split on a numeric column."""
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def scan_csv(
    spark: SparkSession, path: str, schema: StructType | str, cols: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header and an explicit schema: no inference, so ids keep leading zeros.

    A line that doesn't fit the schema stops the scan.
    """
    df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST")
    return df.select(*cols) if cols else df


def write_append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    _save(df, target, "append", partition_by)


def write_replace(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the whole target. The target must not be an input of ``df``."""
    _save(df, target, "overwrite", partition_by, partitionOverwriteMode="static")


def _save(df: DataFrame, target: str, mode: str, partition_by: Sequence[str], **options: str) -> None:
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def key_bucket(keys: Sequence[str], buckets: int, name: str = "bucket"):
    """Partition column for :func:`replace_by_key`: a stable hash of the key."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias(name)


def _staging_folder(spark: SparkSession, path: str, batch_id: int | str) -> str:
    tag = hashlib.sha256(path.encode()).hexdigest()[:16]
    return f"{shared_folder(spark)}/replace-{tag}-{batch_id}"


def _by_bucket(df: DataFrame, parts: Sequence[str] = ("bucket",)) -> DataFrame:
    """Rows of a bucket in few files: AQE splits the buckets that are large."""
    return df.hint("rebalance", *parts)


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def replace_by_key(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    batch_id: int | str,
    buckets: int = 64,
    partition_by: Sequence[str] = (),
) -> None:
    """Idempotent reload: rows with the batch's keys are replaced, all others stay.

    The table at ``path`` is partitioned by ``partition_by`` (say, the season; it must follow from the
    key) and within it by a hash bucket of the key. Only the buckets the batch touches are
    rewritten, so one game costs a bucket of its season, not a share of the table. Their new
    content is first written in full to a staging folder in the shared folder and then
    swapped in with a dynamic partition overwrite, so no job overwrites what it reads. Calling again
    with the same ``batch_id`` after a failed swap redoes the swap from staging;
    after a good swap staging is dropped, so an old batch can never undo a newer one.
    Null keys are keys like any other. The layout is kept beside the table; a call that states
    another one is refused, and so is a new batch for a folder that holds data without a layout: which of
    its rows share a bucket with the batch isn't known, and the swap would remove them.
    """
    spark = batch.sparkSession
    keys, parts = list(keys), [*partition_by, "bucket"]
    layout = json.dumps({"keys": keys, "buckets": buckets, "partition_by": list(partition_by)})
    stored = read_note(spark, f"{path}/_layout")
    if stored is not None and stored != layout:
        raise ValueError(f"the table has the layout {stored}, not {layout}")
    staging = _staging_folder(spark, path, batch_id)
    if not path_exists(spark, f"{staging}/_SUCCESS"):
        if stored is None and holds_data(spark, path):
            raise ValueError(f"{path} holds data but no layout; load it anew into an empty folder")
        incoming = batch.withColumn("bucket", key_bucket(keys, buckets)).persist()
        try:
            merged = incoming
            if stored is not None:
                touched = incoming.select(*parts).distinct()
                # At most ``buckets`` numbers: they prune the table's partitions.
                numbers = [r[0] for r in touched.select("bucket").distinct().collect()]
                rows = spark.read.schema(incoming.schema).parquet(path).where(F.col("bucket").isin(numbers))
                rows = rows.join(touched, _null_safe(rows, touched, parts), "left_semi")
                sent = incoming.select(*dict.fromkeys([*parts, *keys])).distinct()
                survivors = rows.join(sent, _null_safe(rows, sent, sent.columns), "left_anti")
                merged = survivors.select(*incoming.columns).unionByName(incoming)
            _write_buckets(_by_bucket(merged, parts), staging, "static", parts)
        finally:
            incoming.unpersist()
    if stored is None:
        write_note(spark, f"{path}/_layout", layout)
    staged = spark.read.schema(StructType([*batch.schema.fields]).add("bucket", "integer")).parquet(staging)
    _write_buckets(_by_bucket(staged, parts), path, "dynamic", parts)
    drop_folder(spark, staging)


def _write_buckets(df: DataFrame, path: str, mode: str, parts: Sequence[str]) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*parts).parquet(path)


def reset_table(spark: SparkSession, name: str, database: str | None = None) -> None:
    """Drop a declared table and create it again, empty. Other names are refused."""
    declared = registry()
    if name not in declared:
        raise ValueError(f"{name!r} is not a declared table; valid: {sorted(declared)}")
    spark.sql(f"DROP TABLE IF EXISTS {_qualified(name, database)}")
    create_table(spark, name, declared[name], database)


def create_table(
    spark: SparkSession, name: str, schema: StructType, database: str | None = None
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_qualified(name, database)} ({columns}) USING parquet")


def create_all(
    spark: SparkSession,
    tables: Mapping[str, StructType] | None = None,
    database: str | None = None,
) -> list[str]:
    """Create every declared table that does not exist yet."""
    tables = registry() if tables is None else tables
    for name, schema in tables.items():
        create_table(spark, name, schema, database)
    return list(tables)
