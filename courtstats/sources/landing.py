"""Landing zone: payloads arrive as files, one folder per endpoint and result set.

No line is lost in silence: a scan or stream stops at a line that doesn't fit its schema, and the checked
forms send such lines to a lane of their own, with file, line and reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtstats.operators.sets import union_all


def landing_path(root: str, endpoint: str, index: int = 0) -> str:
    return f"{root.rstrip('/')}/{endpoint}/{index}"


def scan_landing(
    spark: SparkSession,
    root: str,
    endpoint: str,
    schema: StructType | str,
    index: int | Sequence[int] = 0,
    fmt: str = "json",
    with_file: bool = False,
) -> DataFrame:
    """One result set of an endpoint, or the union of several.

    The schema is explicit, so a scan starts without an inference pass. A line that doesn't fit it stops the
    scan; :func:`check_landing` keeps going. ``with_file`` adds the file each row came from.
    """
    indexes = [index] if isinstance(index, int) else list(index)
    frames = [
        spark.read.schema(schema).format(fmt).option("mode", "FAILFAST").load(landing_path(root, endpoint, i))
        for i in indexes
    ]
    if with_file:
        frames = [f.select("*", F.col("_metadata.file_path").alias("source_file")) for f in frames]
    return union_all(frames)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    files_per_batch: int = 1000,
) -> DataFrame:
    """The same files as a stream, a bounded number per micro-batch. A line that doesn't fit the schema stops it."""
    return (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def land(df: DataFrame, root: str, endpoint: str, index: int = 0, fmt: str = "json") -> str:
    """Write a payload into the landing zone; returns its folder."""
    path = landing_path(root, endpoint, index)
    df.write.mode("append").format(fmt).save(path)
    return path


def scan_dimension(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A list of records (teams, players) kept as JSON lines; one that doesn't fit the schema stops the scan."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


# --- Checked lines ----------------------------------------------------------------------

#: Columns of the quarantine lane.
QUARANTINE = ["source_file", "line", "reason"]
_PARSED, _BROKEN = "__parsed", "__broken"


def landing_lines(
    spark: SparkSession, root: str, endpoint: str, index: int | Sequence[int] = 0, files_per_batch: int | None = None
) -> DataFrame:
    """(source_file, line) of the JSON lines of one or several result sets; a stream if ``files_per_batch`` is given."""
    indexes = [index] if isinstance(index, int) else list(index)
    paths = [landing_path(root, endpoint, i) for i in indexes]
    if files_per_batch is None:
        reader = spark.read
    else:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    line = [F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line")]
    return union_all([reader.text(path).select(*line) for path in paths])


def parse_lines(lines: DataFrame, schema: StructType | str) -> DataFrame:
    """Every line with its parsed columns and the ``reason`` why it doesn't fit, null for a good line.

    Reasons: ``blank``, ``not a JSON object``, or ``type of`` and the columns whose values aren't of the declared type. A
    column that the object lacks is null, further ones are ignored.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # The reader's own rule decides whether a line fits, so checked and plain scans agree on good lines.
    with_rest = StructType([*kinds.fields]).add(_BROKEN, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = lines.withColumn(_PARSED, F.from_json("line", with_rest, options))
    broken = F.col(_PARSED).isNull() | F.col(f"{_PARSED}.{_BROKEN}").isNotNull()
    is_object = F.get_json_object("line", "$").startswith("{") & F.from_json("line", "map<string,string>").isNotNull()
    wrong = F.array_compact(F.array(*[F.when(_is_wrong(f.name, f.dataType), F.lit(f.name)) for f in kinds.fields]))
    reason = (
        F.when(F.trim("line") == "", "blank")
        .when(~broken, F.lit(None))
        .when(~F.coalesce(is_object, F.lit(False)), "not a JSON object")
        .otherwise(F.concat(F.lit("type of "), F.array_join(wrong, ", ")))
    )
    return parsed.select("source_file", "line", reason.alias("reason"), *[F.col(_PARSED)[f.name].alias(f.name) for f in kinds.fields])


def _is_wrong(name: str, kind):
    """Whether a line has a value for a column but not of its type, judged on that column alone."""
    alone = F.from_json("line", StructType().add(name, kind).add(_BROKEN, "string"), {"columnNameOfCorruptRecord": _BROKEN})
    return alone[_BROKEN].isNotNull()


def good_lines(parsed: DataFrame, with_file: bool = False) -> DataFrame:
    rows = parsed.where(F.col("reason").isNull())
    return rows.drop("line", "reason") if with_file else rows.drop(*QUARANTINE)


def quarantined(parsed: DataFrame) -> DataFrame:
    """(source_file, line, reason) of the lines that don't fit; blank lines are none."""
    return parsed.where(F.col("reason").isNotNull() & (F.col("reason") != "blank")).select(*QUARANTINE)


def reconcile(parsed: DataFrame, good: DataFrame, lane: DataFrame) -> DataFrame:
    """Per file: lines landed, rows loaded, lines quarantined, blank lines, and whether they add up.

    ``good`` and ``lane`` are what was stored, with their ``source_file``; a file that nothing was stored of has zeros.
    """
    count = F.count(F.lit(1))
    landed = parsed.groupBy("source_file").agg(count.alias("landed"), F.count_if(F.col("reason") == "blank").alias("blank"))
    loaded = good.groupBy("source_file").agg(count.alias("loaded"))
    kept = lane.groupBy("source_file").agg(count.alias("quarantined"))
    out = landed.join(loaded, "source_file", "left").join(kept, "source_file", "left").fillna(0, ["loaded", "quarantined"])
    adds_up = F.col("landed") == F.col("loaded") + F.col("quarantined") + F.col("blank")
    return out.withColumn("adds_up", adds_up)


def load_landing(
    spark: SparkSession,
    root: str,
    endpoint: str,
    schema: StructType | str,
    target: str,
    lane: str,
    checkpoint: str,
    index: int | Sequence[int] = 0,
    files_per_batch: int = 1000,
) -> None:
    """Load what has landed since the last run: fitting lines to ``target``, the others to ``lane``, then stop.

    Both are Parquet folders, partitioned by batch. A batch that is run again replaces its own partition in both.
    """
    lines = landing_lines(spark, root, endpoint, index, files_per_batch)

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(batch, schema).persist()
        try:
            for rows, path in ((good_lines(parsed, with_file=True), target), (quarantined(parsed), lane)):
                (
                    rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("batch_id")
                    .parquet(path)
                )
        finally:
            parsed.unpersist()

    query = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
