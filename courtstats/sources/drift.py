"""Parquet files whose columns change type or come and go from load to load.

Footers are read in parallel tasks, one row per file and column. A lattice gives each column the narrowest type that
holds all its values, with a report of what was widened; files of one shape are then read together, cast and united.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.operators.sets import union_all
from courtstats.session import materialize

#: Numeric types from narrow to wide; above them, and above all other types, is string.
NUMERIC = ["int", "bigint", "double"]
#: Different shapes of files that one read accepts. Each is a scan of its own in the plan.
MAX_SHAPES = 200

_SPARK_TYPES = {
    pa.int8(): "int", pa.int16(): "int", pa.int32(): "int", pa.uint8(): "int", pa.uint16(): "int",
    pa.int64(): "bigint", pa.uint32(): "bigint", pa.float32(): "double", pa.float64(): "double",
    pa.string(): "string", pa.large_string(): "string", pa.bool_(): "boolean", pa.date32(): "date", pa.binary(): "binary",
}


def _type_name(kind: pa.DataType) -> str:
    """Spark's name of a column type; one outside the lattice and the plain types is named as Arrow names it."""
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_decimal128(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return _SPARK_TYPES.get(kind, str(kind))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
    return fs.FileSystem.from_uri(parts._replace(scheme=scheme).geturl())


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, column, type) of every column of every Parquet file below ``path``, from the footers alone.

    Paths are listed by Spark and dealt over tasks; no data page is read. Files of other storage than a local or
    shared disk are opened with the credentials that tasks find in their environment.
    """
    paths = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"file": [], "rows": [], "column": [], "type": []}
            for uri in batch.column("path").to_pylist():
                system, place = _open(uri)
                with system.open_input_file(place) as source:
                    told = pq.ParquetFile(source)
                    for field in told.schema_arrow:
                        out["file"].append(uri)
                        out["rows"].append(told.metadata.num_rows)
                        out["column"].append(field.name)
                        out["type"].append(_type_name(field.type))
            schema = pa.schema([("file", pa.string()), ("rows", pa.int64()), ("column", pa.string()), ("type", pa.string())])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return paths.mapInArrow(run, "file string, rows long, column string, type string")


def widest(types: Column) -> Column:
    """The narrowest type that holds all values of an array of distinct type names."""
    ranks = F.transform(types, lambda t: F.array_position(F.array(*map(F.lit, NUMERIC)), t))
    numeric = F.forall(ranks, lambda r: r > 0)
    return (
        F.when(F.size(types) == 1, types[0])
        .when(numeric, F.element_at(F.array(*map(F.lit, NUMERIC)), F.array_max(ranks).cast("int")))
        .otherwise("string")
    )


def drift_report(found: DataFrame) -> DataFrame:
    """One row per column of :func:`footers` rows: column, type, types, rows, widened, inexact.

    ``types``: all types met, sorted, comma-joined; ``rows``: rows of the files that have the column. ``inexact``: whole
    numbers of 64 bits became doubles, which hold them exactly up to 2^53 only.
    """
    types = F.array_sort(F.collect_set("type"))
    report = found.groupBy("column").agg(types.alias("types"), F.sum("rows").alias("rows"))
    kind = widest(F.col("types"))
    return report.select(
        "column",
        kind.alias("type"),
        F.array_join("types", ",").alias("types"),
        "rows",
        (F.size("types") > 1).alias("widened"),
        ((kind == "double") & F.array_contains("types", "bigint")).alias("inexact"),
    )


def scan_drifting(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` as one table: columns in name order, each of its widest type, NULL where absent.

    Files of one shape are one scan, so filters and column choices reach it; casts are of the widened columns only.
    The driver holds the file names, as it does for any scan, the columns, and at most ``MAX_SHAPES`` shapes. Column
    names are told apart by case, and a name that another differs from by case only is refused.
    """
    found = materialize(footers(spark, path))
    wide = {r["column"]: r for r in drift_report(found).collect()}
    if not wide:
        raise ValueError(f"no Parquet file with columns below {path}")
    if len({c.lower() for c in wide}) < len(wide):
        raise ValueError("columns that differ by case only: " + ", ".join(sorted(wide)))
    nested = sorted(c for c, r in wide.items() if r["widened"] and any(mark in r["types"] for mark in "<["))
    if nested:
        raise ValueError("nested columns whose types differ: " + ", ".join(nested))
    shape = F.array_sort(F.collect_list(F.struct("column", "type")))
    shapes = found.groupBy("file").agg(shape.alias("shape")).groupBy("shape").agg(F.collect_list("file").alias("files"))
    kinds = shapes.limit(MAX_SHAPES + 1).collect()
    if len(kinds) > MAX_SHAPES:
        raise ValueError(f"more than {MAX_SHAPES} shapes of files below {path}")
    frames = []
    for kind in sorted(kinds, key=lambda k: k["shape"]):
        rows = spark.read.parquet(*sorted(kind["files"]))
        frames.append(rows.select(*[_as_wide(c, wide[c]["type"], t) for c, t in kind["shape"]]))
    return union_all(frames).select(*[f"`{c}`" for c in sorted(wide)])


def _as_wide(column: str, wide: str, kind: str) -> Column:
    found = F.col(f"`{column}`")
    # Names of nested types are Arrow's; those columns are never widened and pass as they are. Narrow forms such as
    # smallint and float are of the lattice's types by name only, so numbers are always cast.
    return found.cast(wide).alias(column) if wide != kind or wide in NUMERIC else found
