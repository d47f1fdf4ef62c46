"""Incremental load: unseen rows only, restartable, several facets and endpoints per game.

The tables of an endpoint are :class:`SnapshotTables`. A batch becomes visible in all of them at once, together with its
number: a batch that is run again finds itself there and changes nothing, a broken one leaves nothing visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.operators.windows import dedupe
from courtstats.session import path_exists
from courtstats.sources.snapshots import ATTEMPTS, Conflict, SnapshotTables

Facet = Callable[[DataFrame], DataFrame]

#: Table of the games of which any row has been loaded.
DONE = "_loaded_keys"


@dataclass(frozen=True)
class RowFacet:
    """A table made from the payload: how, and which columns tell its rows apart."""

    build: Facet
    row_keys: Sequence[str]


def load_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    facets: Mapping[str, RowFacet],
    keys: Sequence[str],
    run_id: str,
    buckets: int = 64,
) -> None:
    """Write one batch: rows whose row key no other batch has loaded.

    A game may be spread over any number of batches: rows, not games, are told apart. A batch is compared with those
    stored folders alone whose key index may hold one of its games. If another writer has changed one of them
    meanwhile, the batch looks again.
    """
    store = SnapshotTables(batch.sparkSession, root, buckets)
    keys = list(keys)
    batch = batch.persist()
    try:
        sent = batch.count()
        for attempt in range(ATTEMPTS):
            base = store.latest()
            if base.applied.get(run_id, -1) >= batch_id:
                return
            here = batch.select(*keys).distinct()
            changes = []
            for name, facet in {**facets, DONE: RowFacet(lambda _, here=here: here, keys)}.items():
                rows = facet.build(batch)
                new = store.unseen(base, name, rows, facet.row_keys)
                # Rows are kept by game, unless a row's key says nothing of its game.
                by = keys if set(keys) <= set(facet.row_keys) else list(facet.row_keys)
                changes.append(store.stage(base, name, new, by, sent))
            try:
                store.commit(base, changes, run_id, batch_id)
                return
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
    finally:
        batch.unpersist()


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run a checkpoint belongs to, kept beside it; a new checkpoint is a new run.

    Batch numbers start at zero with every checkpoint, so they only count together with the run.
    """
    path = f"{checkpoint}/_run"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        named = spark.range(1).select(F.lit(uuid.uuid4().hex).alias("run_id"))
        named.write.mode("overwrite").parquet(path)
    return spark.read.schema("run_id string").parquet(path).first()[0]


def incremental_load(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    facets: Mapping[str, RowFacet],
    keys: Sequence[str],
    buckets: int = 64,
) -> None:
    """Load everything that has landed since the last run, then stop.

    The stream's checkpoint remembers the files, the tables remember the rows. If the checkpoint is
    lost, all files are read again and no row is written twice. ``buckets`` holds for tables that are new: a
    bucket's rows should fit a few tasks.
    """
    run_id = _run_of(stream.sparkSession, checkpoint)
    query = (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: load_batch(batch, batch_id, root, facets, keys, run_id, buckets)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class Endpoint:
    """A stream of payloads and the tables made from it."""

    stream: DataFrame
    facets: Mapping[str, RowFacet]


def load_endpoints(
    endpoints: Mapping[str, Endpoint], root: str, checkpoint: str, keys: Sequence[str], buckets: int = 64
) -> None:
    """Load all endpoints of the games, each with a checkpoint and a key table of its own."""
    for name, endpoint in endpoints.items():
        incremental_load(endpoint.stream, f"{root}/{name}", f"{checkpoint}/{name}", endpoint.facets, keys, buckets)


def complete_keys(spark: SparkSession, root: str, tables: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Games that have rows in every one of the tables (``endpoint/table``): only these are done."""
    frames = [read_loaded(spark, root, t).select(*keys).distinct() for t in tables]
    return reduce(lambda a, b: a.intersect(b), frames)


def read_loaded(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A loaded table, or that of an endpoint (``endpoint/table``), as of its latest version."""
    *endpoint, name = table.split("/")
    return SnapshotTables(spark, "/".join([root, *endpoint])).read(name)


def loaded_keys(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Games of which any row has been loaded."""
    return SnapshotTables(spark, root).read(DONE).select(*keys).distinct()


def unique_rows(build: Facet, keys: Sequence[str], order: Sequence[str]) -> RowFacet:
    """A facet that keeps the first row per key within a batch."""
    return RowFacet(lambda df: dedupe(build(df), keys, order), keys)
