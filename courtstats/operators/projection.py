"""Projection and filter operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from courtstats.functions.columns import numeric


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _lenient_cast(df: DataFrame, name: str, target: DataType) -> Column:
    """Cast to the declared type; text that does not parse becomes NULL."""
    source = df.schema[name].dataType
    if source == target:
        return _quoted(name)
    if isinstance(source, StringType):
        return _quoted(name).try_cast(target)
    return _quoted(name).cast(target)


def conform(
    df: DataFrame,
    schema: StructType,
    aliases: Mapping[str, Sequence[str]],
    mode: str = "first_present",
) -> DataFrame:
    """Bring a payload into a declared schema.

    Each target column takes the first of its aliases that the payload has,
    then its own name; unknown columns are dropped and absent ones are NULL.
    ``mode="coalesce"`` instead takes the first non-null value per row.
    """
    if mode not in ("first_present", "coalesce"):
        raise ValueError(f"unknown mode {mode!r}")
    have = set(df.columns)
    out = []
    for field in schema.fields:
        names = [a for a in aliases.get(field.name, []) if a in have]
        if field.name in have and field.name not in names:
            names.append(field.name)
        if not names:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if mode == "first_present":
            names = names[:1]
        out.append(
            F.coalesce(*[_lenient_cast(df, n, field.dataType) for n in names]).alias(field.name)
        )
    return df.select(*out)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict selection: a missing column is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[_quoted(c) for c in cols])


def project_available(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Selection of those columns that exist, in the order given."""
    have = set(df.columns)
    return df.select(*[_quoted(c) for c in cols if c in have])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def ensure_columns(df: DataFrame, cols: Iterable[str], default=0) -> DataFrame:
    """Add the columns that are missing; fill NULLs of those that exist."""
    have = set(df.columns)
    return df.withColumns(
        {
            c: F.coalesce(_quoted(c), F.lit(default)) if c in have else F.lit(default)
            for c in cols
        }
    )


def to_numbers(df: DataFrame, cols: Sequence[str], errors: str = "null") -> DataFrame:
    return df.withColumns({c: numeric(df, c, errors) for c in cols})


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def split_by_marker(
    df: DataFrame, col: str, home: str = "vs.", away: str = "@"
) -> tuple[DataFrame, DataFrame]:
    """Home rows and away rows, told apart by literal text."""
    return df.where(F.col(col).contains(home)), df.where(F.col(col).contains(away))
