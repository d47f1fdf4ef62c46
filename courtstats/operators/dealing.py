"""How many tasks a step's rows are dealt to.

Left alone, AQE merges a shuffle's partitions until there are about as many as cores, so that what one task sorts or
hashes grows with the table. A step whose rows are counted beforehand is dealt to as many tasks as their number needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

#: Rows of a task of a step that is dealt by their number.
TASK_ROWS = 500_000


def parts_for(rows: int) -> int:
    """Tasks that so many rows are dealt to: at least one."""
    return max(1, -(-rows // TASK_ROWS))


def dealt(df: DataFrame, keys: Sequence[str | Column], rows: int) -> DataFrame:
    """Rows dealt by their keys to the tasks that ``rows`` rows need, or a task a core; AQE keeps a number that is given."""
    return df.repartition(max(parts_for(rows), df.sparkSession.sparkContext.defaultParallelism), *keys)
