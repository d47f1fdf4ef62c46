"""Data-quality and catalog operators. Reports are DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtstats.operators.joins import missing_keys


def _counts(frames: Mapping[str, DataFrame], name: str) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias(name), "rows")
        for t, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def audit_schema(
    spark: SparkSession,
    registry: Mapping[str, StructType],
    tables: Mapping[str, DataFrame],
    with_rows: bool = False,
) -> DataFrame:
    """Declared against actual columns, one row per declared table.

    status is MISSING_TABLE, MISSING_COLUMNS or OK; extra columns and differing
    types are listed but do not change it. ``with_rows`` adds the row counts.
    """
    rows = []
    for name, schema in registry.items():
        if name not in tables:
            rows.append((name, "MISSING_TABLE", ",".join(sorted(schema.names)), "", ""))
            continue
        actual = {f.name: f.dataType for f in tables[name].schema.fields}
        missing = sorted(c for c in schema.names if c not in actual)
        extra = sorted(c for c in actual if c not in schema.names)
        types = sorted(
            f.name for f in schema.fields if f.name in actual and actual[f.name] != f.dataType
        )
        status = "MISSING_COLUMNS" if missing else "OK"
        rows.append((name, status, ",".join(missing), ",".join(extra), ",".join(types)))
    report = spark.createDataFrame(
        rows,
        "table_name string, status string, missing string, extra string, retyped string",
    )
    if not with_rows:
        return report
    known = {t: df for t, df in tables.items() if t in registry}
    return report.join(_counts(known, "table_name"), "table_name", "left")


def tables_to_fix(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status") != "OK").select("table_name")


def has_columns(df: DataFrame, cols: Sequence[str]) -> bool:
    return set(cols) <= set(df.columns)


def health(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Sequence[str]
) -> DataFrame:
    """Row count and OK, EMPTY or NOT_FOUND per expected table."""
    known = {t: tables[t] for t in expected if t in tables}
    absent = [(t, None) for t in expected if t not in tables]
    parts = []
    if known:
        parts.append(_counts(known, "table_name"))
    if absent:
        parts.append(spark.createDataFrame(absent, "table_name string, rows long"))
    status = (
        F.when(F.col("rows").isNull(), "NOT_FOUND").when(F.col("rows") > 0, "OK").otherwise("EMPTY")
    )
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def profile(
    spark: SparkSession, tables: Mapping[str, DataFrame], failures: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per table and column: position, type and row count; failed reads carry an error."""
    columns = [
        (t, i, f.name, f.dataType.simpleString())
        for t, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    described = spark.createDataFrame(
        columns, "table_name string, position int, column_name string, data_type string"
    )
    out = described.join(_counts(tables, "table_name"), "table_name").withColumn(
        "error", F.lit(None).cast("string")
    )
    if failures:
        failed = spark.createDataFrame(list(failures.items()), "table_name string, error string")
        out = out.unionByName(failed, allowMissingColumns=True)
    return out


def column_report(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns of a table: whether each is there, and its type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, c in actual, actual.get(c)) for c in wanted]
    return df.sparkSession.createDataFrame(rows, "column_name string, found boolean, data_type string")


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, top: int = 3) -> DataFrame:
    """One row per column: rows, nulls and their share, smallest and largest value, distinct values and the most frequent ones.

    All come from one aggregate that tasks combine: sketches stand for distinct and frequent values, so both are
    estimates for columns of many values and exact for columns of few. ``frequent`` is an array of (item, count) as text. Nested
    columns have counts only; an empty table has zeros.
    """
    chosen = {f.name: f.dataType for f in df.schema.fields if cols is None or f.name in cols}
    parts = []
    for name, kind in chosen.items():
        flat = kind.typeName() not in ("array", "map", "struct", "variant", "binary")
        text = f"cast({f'`{name}`' if flat else 'null'} as string)"
        items = F.expr(f"approx_top_k({text}, {top}, 10000)")
        frequent = F.transform(items, lambda e: F.struct(e["item"].alias("item"), e["count"].alias("count")))
        parts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
                (F.min(f"`{name}`") if flat else F.lit(None)).cast("string").alias("smallest"),
                (F.max(f"`{name}`") if flat else F.lit(None)).cast("string").alias("largest"),
                F.approx_count_distinct(F.expr(text), 0.01).alias("distinct_values"),
                F.filter(frequent, lambda e: e["item"].isNotNull()).alias("frequent"),
            )
        )
    rows = df.agg(F.array(*parts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    share = F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows"))
    return rows.withColumn("null_share", share)


def completeness(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """Keys that do not have exactly ``n`` rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") != n)


def load_status(target: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct target keys, distinct done keys, and keys still to do."""
    keys = list(keys)
    count = F.count(F.lit(1))
    todo = missing_keys(target, done, keys).agg(count.alias("v"))
    return (
        target.select(*keys)
        .distinct()
        .agg(count.alias("target"))
        .withColumns(
            {
                "done": done.select(*keys).distinct().agg(count.alias("v")).scalar(),
                "to_do": todo.scalar(),
            }
        )
    )


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct non-null fact keys without a dimension row."""
    keys = fact.select(F.col(fact_key).alias("key")).where(F.col("key").isNotNull())
    return missing_keys(keys, dim.select(F.col(dim_key).alias("key")), ["key"])
