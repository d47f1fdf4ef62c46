"""Small files and folders beside tables, on any file system that Spark itself reads and writes.

All calls go through Spark's Hadoop file systems, so ``s3a``, ``abfss``, ``hdfs`` and local paths work with the
session's own credentials, and a path without a scheme means the same place as in ``spark.read``.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, in order; none if there is no such folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file with its folders, over an older one."""
    _write(spark, path, text, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; False if another writer was first. Readers never see a part of it.

    On a local disk a finished file is linked to its name. Elsewhere the file system's own exclusive creation
    decides; on ``s3a`` that needs conditional writes to be on (the default of current releases).
    """
    system, place = _place(spark, path)
    if system.getUri().getScheme() == "file":
        target = urlparse(place.toUri().toString()).path
        os.makedirs(os.path.dirname(target), exist_ok=True)
        made = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
        with open(made, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(made, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(made)
    try:
        _write(spark, path, text, False)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or system.exists(place):
            return False
        raise


def _write(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    system, place = _place(spark, path)
    stream = system.create(place, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it isn't there."""
    system, place = _place(spark, path)
    system.delete(place, True)
