"""Set operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats.operators.joins import missing_keys as key_difference  # noqa: F401


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_sides(
    df: DataFrame,
    home: str,
    away: str,
    values: dict[str, str],
    keep: Sequence[str] = (),
    name: str = "Team",
    side_name: str | None = None,
) -> DataFrame:
    """One game row to a home row and a sign-flipped away row, in a single scan.

    ``values`` maps a home-side column to its output name; ``side_name`` adds a
    column that says "home" or "away".
    """

    def side(team: str, label: str, sign: int) -> Column:
        marker = [F.lit(label).alias(side_name)] if side_name else []
        return F.struct(
            F.col(team).alias(name),
            *marker,
            *[(F.col(c) * F.lit(sign)).alias(out) for c, out in values.items()],
        )

    rows = df.select(*keep, F.explode(F.array(side(home, "home", 1), side(away, "away", -1))).alias("__side"))
    return rows.select(*keep, "__side.*")
