"""Registry, table access and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rows of a lookup table up to which it is sent to every task; above, it is shuffled.
BROADCAST_ROWS = 200_000

#: Rows of a batch that goes to Python, and the setting that says so.
BATCH_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Declared schemas: a read then starts without an inference job.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

#: White space between words, as the contracts of the word operators define it.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle SQL if SQL can state it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a lookup table once and hint it for broadcast if it has at most ``rows`` rows.

    A larger one is returned without a hint, so the join shuffles both sides.
    """
    kept = materialize(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows, sent to Python in batches that suit long texts.

    A batch is held as a whole on both sides. Spark's default of 10,000 rows means tens to hundreds of
    megabytes of text; a session that states another number keeps it.
    """
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_SETTING)) == 10_000:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body).getItem(0)
