"""Scalar expressions used by the operators and plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from courtstats.schemas import SEASON_TYPES

# Characters a plain decimal number may use. Guards the cast against the
# spellings Java accepts but a score never has ("12d", "0x1p3", "NaN").
_NUMERIC_TEXT = r"^[0-9eE+.\s-]+$"


def to_number(text: Column, errors: str = "null") -> Column:
    """Text to DOUBLE. ``errors="null"`` maps bad text to NULL, ``"raise"`` fails."""
    if errors == "raise":
        return text.cast("double")
    if errors != "null":
        raise ValueError(f"errors must be 'null' or 'raise', not {errors!r}")
    return F.when(text.rlike(_NUMERIC_TEXT), text.try_cast("double"))


def numeric(df: DataFrame, name: str, errors: str = "null") -> Column:
    """Column ``name`` as DOUBLE; text goes through :func:`to_number`."""
    if isinstance(df.schema[name].dataType, StringType):
        return to_number(F.col(name), errors)
    return F.col(name).cast("double")


def iso_date(text: Column) -> Column:
    """Date part of an ISO timestamp text such as ``2024-01-05T00:00:00``; bad text is NULL."""
    return F.split(text, "T").getItem(0).try_cast("date")


def parse_minutes(text: Column, fallback: Column | None = None) -> Column:
    """``m:ss`` or a plain number to minutes; otherwise ``fallback`` (or NULL)."""
    parts = F.split(text, ":")
    clock = parts.getItem(0).try_cast("double") + parts.getItem(1).try_cast("double") / F.lit(60.0)
    value = F.when(F.size(parts) == 2, clock).when(F.size(parts) == 1, to_number(text))
    return value if fallback is None else F.coalesce(value, fallback.cast("double"))


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next edge]``; values outside all bins are NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def margin(home: Column, away: Column) -> Column:
    return home - away


def negate(value: Column) -> Column:
    return value * F.lit(-1)


def sign_flag(value: Column, positive: str = "win", other: str = "loss") -> Column:
    """``positive`` above zero, else ``other``."""
    return F.when(value > 0, positive).otherwise(other)


def label_if(value: Column, below: float, label: str, otherwise: str) -> Column:
    return F.when(value < F.lit(below), label).otherwise(otherwise)


def format_number(value: Column, decimals: int = 1, signed: bool = False) -> Column:
    """Fixed-decimal text, with an explicit plus sign when ``signed``."""
    pattern = f"%{'+' if signed else ''}.{decimals}f"
    return F.when(value.isNotNull(), F.format_string(pattern, value.cast("double")))


def decode_season(season_id: Column) -> Column:
    """``22024`` to struct(season_type, start_year)."""
    kind = F.substring(season_id, 1, 1)
    name = None
    for digit, label in SEASON_TYPES.items():
        name = F.when(kind == digit, label) if name is None else name.when(kind == digit, label)
    return F.struct(
        name.alias("season_type"),
        F.substring(season_id, 2, 4).try_cast("int").alias("start_year"),
    )


def argmax_name(names: Sequence[str]) -> Column:
    """Name of the largest of several columns; NULLs never win, the first name wins ties."""
    best = F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    return F.coalesce(*[F.when(F.col(n) == best, n) for n in names])


def argmin_name(names: Sequence[str]) -> Column:
    """Name of the smallest of several columns; NULLs never win, the first name wins ties."""
    best = F.least(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    return F.coalesce(*[F.when(F.col(n) == best, n) for n in names])


def rounded(value: Column, decimals: int) -> Column:
    """Rounded double without a negative zero, so that equal results also compare equal."""
    short = F.round(value, decimals)
    return F.when(short == 0, F.lit(0.0)).otherwise(short)
