"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from courtstats import files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot game or team may hold a large share of the rows: let AQE split its
    # join partitions even when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording the Python call site of every expression slows plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "courtstats", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own; on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="courtstats-")
    sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds more than hidden files and notes, which start with a dot or an underscore."""
    return any(not name.startswith((".", "_")) for name in files.names(spark, path))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a staging folder this package wrote."""
    files.remove(spark, path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """A short text kept beside a table, or None."""
    return files.read_text(spark, path) if files.exists(spark, path) else None


def write_note(spark: SparkSession, path: str, text: str) -> None:
    files.write_text(spark, path, text)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small intermediate once and cut its lineage, in the shared folder.

    Later jobs read the checkpoint files, which outlive any executor.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
