"""Quality rule: hashed n-gram likelihood ratio between trusted documents and the raw corpus.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials are counted:
over all documents, and over all trusted ones (labelled good and not toxic). A document's score is the mean log ratio of
its n-grams. The threshold is the ``tail`` quantile of the scores of trusted documents kept out of the
counts, found by exact rank selection without collecting them, so it moves with the corpus and not with single documents; every document
is then judged by the same fixed number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.operators.quantiles import values_at_ranks
from courtstats.session import materialize

from .common import query, read, small, small_batches
from .wordscan import BASE, Base, Scan, mix, owners, per_text, scans

BUCKETS = 1 << 16
TAIL = 0.001
#: N-grams of score zero added to every document, so that a few words decide little.
SHRINK = 10
#: One in so many trusted documents sets the threshold and isn't counted.
HELD_BACK = 4


def ngram_buckets(word_hash: np.ndarray, word_at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all words and neighbouring pairs of words."""
    who = owners(word_at)
    pair = np.flatnonzero(who[1:] == who[:-1])
    pairs = mix(word_hash[pair] * np.uint64(BASE) + word_hash[pair + 1])
    keys = np.concatenate([word_hash, pairs])
    return np.concatenate([who, who[pair]]), (keys % np.uint64(buckets)).astype(np.int64)


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """All ids labelled good and not toxic.

    Repeated labels of an id count once; an id with contradicting labels isn't trusted.
    """
    judged = labels.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    return judged.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select(key)


def _held_back(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("threshold")), F.lit(HELD_BACK)) == 0


class LikelihoodRatio:
    """Log ratio per bucket and the threshold; built by ``fit``."""

    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold

    @property
    def buckets(self) -> int:
        return len(self.ratio)

    def scores(self, word_hash: np.ndarray, word_at: np.ndarray) -> np.ndarray:
        who, bucket = ngram_buckets(word_hash, word_at, self.buckets)
        texts = len(word_at) - 1
        total = np.bincount(who, self.ratio[bucket], texts)
        return total / (np.bincount(who, minlength=texts) + SHRINK)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    tail: float = TAIL,
    key: str = "doc_id",
    text: str = "text",
) -> LikelihoodRatio:
    """Count both multinomials over all documents, then set the threshold.

    What reaches the driver: two counts per bucket, and the threshold. The trusted ids are sent to every task if
    they are few (counted), else the documents are shuffled to them. Without trusted documents all ratios are zero and
    nothing is refused.
    """
    trusted = small(trusted_ids(labels).withColumnRenamed("doc_id", "_trusted"))
    inputs = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known, back = F.col("_trusted").isNotNull(), _held_back(F.col("key"))
    marked = inputs.join(trusted, F.col("key") == F.col("_trusted"), "left").select(
        "text", (known & ~back).alias("target"), (known & back).alias("held")
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            wanted = batch.column("target").to_numpy(zero_copy_only=False)
            at = 0
            for n, scan in scans(batch.column("text")):
                who, bucket = ngram_buckets(scan.word_hash, scan.word_at, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[wanted[at : at + n][who]], minlength=buckets)
                at += n
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(raw[met]), pa.array(target[met])], names=["bucket", "raw", "target"]
        )

    sums = (
        marked.select("text", "target")
        .transform(small_batches).mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[sums["bucket"]] = sums["raw"]
    target[sums["bucket"]] = sums["target"]
    model = LikelihoodRatio(log_ratio(raw, target), -np.inf)
    if target.sum() == 0:
        return model
    held = marked.where("held").select("text")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, scan in scans(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.scores(scan.word_hash, scan.word_at))], names=["score"]
                )

    kept_out = materialize(held.transform(small_batches).mapInArrow(score, "score double"))
    lowest = values_at_ranks(kept_out, [], "score", lambda n: F.array(F.floor((n - 1) * F.lit(tail)) + 1)).first()
    if lowest is not None:
        model.threshold = lowest["value"]
    return model


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of smoothed target over raw shares. The target is smoothed towards the raw shares.

    The prior weighs one n-gram per bucket; a bucket the target never met gets a low ratio.
    """
    if target.sum() == 0:
        return np.zeros(len(raw))
    share = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    prior = float(len(raw))
    return np.log((target + prior * share) / (target.sum() + prior) / share)


def judge(docs: DataFrame, model: LikelihoodRatio, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept.

    ``base_failed``: fewer than 10 words, or over a fifth of the words in repeated windows. ``kept``: not
    failed and a score not below the threshold. Null texts have no words; null keys and repeated rows are
    judged by their text like any other. Other columns are dropped.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, scan in scans(batch.column("text")):
                base = Base(scan)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, n),
                        *[pa.array(getattr(base, name).astype(np.int64)) for name in longs],
                        pa.array(model.scores(base.word_hash, scan.word_at)),
                    ],
                    names=["key", *longs, "score"],
                )
                at += n

    made = source.transform(small_batches).mapInArrow(
        run, f"key {kind}, {', '.join(f'{n} long' for n in longs)}, score double"
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return made.select(
        F.col("key").alias(key),
        *longs,
        "score",
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= float(model.threshold))).alias("kept"),
    )


@query("op1_likelihood_ratio")
def op1_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base rules and the likelihood ratio."""
    docs = read(spark, sf_dir, "documents")
    return judge(docs, fit(docs, read(spark, sf_dir, "labels")))
