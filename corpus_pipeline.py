"""From raw documents to token ids: five stages, each written before the next one reads it.

1. quality classifier: documents that the factorisation machine rejects go;
2. line dedup: repeated passages of lines are cut out of the texts;
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. byte-level BPE: texts become ids, which are decoded again as a check.

Every stage but the last takes and returns the columns of ``documents`` (those that are there), so it
also runs by itself. Stages write below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.llm import bpe, decontaminate, line_dedup, quality_model, simhash
from courtstats.llm.common import read
from courtstats.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the threshold. Labels of ids not among ``docs`` teach nothing.

    Scores are computed on the rows themselves, so repeated rows and null ids need no join.
    """
    model = quality_model.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model, docs.columns)
    return scored.where(F.col("fm_score") >= quality_model.THRESHOLD).drop("fm_score")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of repeated passages; ``n_chars`` follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = line_dedup.dedup_lines(docs, keep=others)
    if "n_chars" in others:
        same = F.col("removed_lines") == 0
        now = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(now))
    return cut.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and the digest of the decoded text of every document."""
    path = bpe.multi_path()
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.col("ids").alias("token_ids"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", cut_repeats),
    ("simhash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level bpe", to_tokens),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for nr, (_, stage) in enumerate(STAGES):
        folder = new_folder(spark, f"corpus-{nr}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
