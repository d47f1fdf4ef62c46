"""Tables of vectors as stored blocks, searched by bounded batches of queries.

Rows lie in blocks of a few thousand, a row of binary columns per block. A search sends a batch of queries (at most
``QUERY_BATCH``) to every task; a task walks its blocks and returns the best few rows of every query, so
neither copies of a vector nor frequent labels collect anywhere, and a repeated task returns the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats.session import materialize

#: Queries that are sent to the tasks at a time.
QUERY_BATCH = 16_384
#: Rows of a block.
BLOCK_ROWS = 1024


def usable(df: DataFrame, key: str, vector: str, others: dict[str, Column] | None = None) -> DataFrame:
    """(key, vec, others...) of the rows that have a key and a vector of finite numbers; vec holds doubles or floats."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, finite)).select(
        F.col(key).cast("long").alias("key"), F.col(vector).alias("vec"), *[c.alias(n) for n, c in (others or {}).items()]
    )


def widest(rows: DataFrame) -> int:
    """Length of the longest vector; shorter ones count as if zeros followed. No rows: 0."""
    return rows.agg(F.max(F.size("vec"))).first()[0] or 0


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """An Arrow column of lists as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), flat.dtype)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def in_blocks(batches: Iterable[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """The same rows as tables of ``rows`` rows; the last may be shorter."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def sample(rows: DataFrame, limit: int) -> pa.Table:
    """At most ``limit`` rows, those of the smallest hash: the same ones for every layout of the table."""
    order = [F.xxhash64("key", "vec"), "key"]
    return rows.orderBy(*order).limit(limit).toArrow()


def spread(blocks: DataFrame) -> DataFrame:
    """Stored blocks dealt evenly over the tasks, so blocks of one hot region don't meet in one."""
    tasks = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    return materialize(blocks.repartition(tasks))


def query_batches(queries: DataFrame, size: int = QUERY_BATCH) -> Iterator[pa.Table]:
    """Stored queries in batches of about half of ``size`` rows; ``uid`` tells them apart."""
    count = queries.count()
    parts = math.ceil(2 * count / size) if count > size else min(count, 1)
    for part in range(parts):
        chosen = queries if parts == 1 else queries.where(F.pmod(F.xxhash64("uid"), F.lit(parts)) == part)
        yield chosen.toArrow()


def search(blocks: DataFrame, columns: Sequence[str], schema: str, start: Callable[[], "Walk"]) -> DataFrame:
    """What ``start().result()`` gives in every task after its blocks have been shown to it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = start()
        for batch in batches:
            for row in range(batch.num_rows):
                walk.see({c: batch.column(n)[row].as_py() for n, c in enumerate(columns)})
        yield from walk.result()

    return blocks.select(*columns).mapInArrow(run, schema)


class Walk:
    """A search within a task."""

    def see(self, block: dict) -> None:
        raise NotImplementedError

    def result(self) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
