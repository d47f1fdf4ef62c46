"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part is computed in time
linear in the non-zero features: half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The machine is fitted by mini-batch gradient steps on at most ``sample_limit`` labelled rows (the
documented bound), whose features are gathered by Spark; every document is scored in parallel. Labels,
language, source and id are no features.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import list_array
from .common import query, read, small_batches
from .wordscan import Base, Scan, mix, owners, per_text, scans

BUCKETS = 1 << 14
FACTORS = 8
SAMPLE_LIMIT = 8_000
THRESHOLD = 0.3
#: Names of the dense features, which follow the word buckets.
STRUCTURE = (
    "symbols", "capitals", "digits", "exclamations", "bars", "marks_at_word_end", "word_length",
    "repeated_lines", "repeated_windows", "distinct_words", "doubled_words", "log_words", "words_a_line",
    "few_words",
)
METADATA = ("n_chars",)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CAPITALS = _table(bytes(range(65, 91)))
_SMALL = _table(bytes(range(97, 123)))
_DIGITS = _table(b"0123456789")
_MARKS = _table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def features(scan: Scan, meta: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cuts per text, feature numbers, values) of all texts of a scan.

    Word features are log counts, scaled to length one per text. ``meta`` has a row per text and a column per
    metadata value (NaN: unknown, taken as what the text itself gives for its length).
    """
    base = Base(scan)
    texts = len(base.n_words)
    who = owners(scan.word_at)
    words = np.maximum(base.n_words, 1)
    keys, counts = np.unique(
        who.astype(np.uint64) * np.uint64(buckets) + mix(base.word_hash) % np.uint64(buckets), return_counts=True
    )
    doc = (keys // np.uint64(buckets)).astype(np.int64)
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(doc, value**2, texts))
    value = value / norm[doc]
    points = np.maximum(per_text(scan.code_points(), scan.text_at) - 1, 1)
    letters = np.maximum(scan.count(_CAPITALS) + scan.count(_SMALL), 1)
    pairs = np.flatnonzero(who[1:] == who[:-1])
    doubled = np.bincount(who[pairs][base.word_hash[pairs] == base.word_hash[pairs + 1]], minlength=texts)
    marked = _MARKS[scan.bytes[scan.word_end - 1]] if len(who) else np.zeros(0, bool)
    lines = np.diff(scan.line_at)
    # Distinct words are counted by their full hashes, not by buckets.
    order = np.lexsort((base.word_hash, who))
    new = np.ones(len(who), bool)
    if len(who):
        new[1:] = (who[order][1:] != who[order][:-1]) | (base.word_hash[order][1:] != base.word_hash[order][:-1])
    distinct = np.bincount(who[order][new], minlength=texts)
    dense = [
        np.sqrt(base.n_symbols / points),
        np.sqrt(scan.count(_CAPITALS) / letters),
        np.sqrt(scan.count(_DIGITS) / points),
        np.sqrt(scan.count(_table(b"!")) / points),
        np.sqrt(scan.count(_table(b"|")) / points),
        per_text(marked, scan.word_at) / words,
        np.minimum(base.word_chars / words / 12, 2),
        base.n_dup_lines / np.maximum(lines, 1),
        base.n_repeat_words / words,
        distinct / words,
        np.sqrt(doubled / words),
        np.log1p(base.n_words) / 8,
        np.log1p(words / np.maximum(lines, 1)) / 6,
        (base.n_words < 10).astype(float),
    ]
    for column in np.asarray(meta, float).reshape(texts, -1).T:
        known = np.where(np.isnan(column) | (column < 0), points, column)
        dense += [np.log1p(known) / 12, np.minimum(np.abs(np.log((known + 1) / (points + 1))), 2)]
    width = len(dense)
    # Each text: its words, then its dense features.
    sparse = np.bincount(doc, minlength=texts)
    cuts = np.concatenate([[0], np.cumsum(sparse + width)])
    index = np.empty(cuts[-1], np.int64)
    values = np.empty(cuts[-1])
    place = np.arange(len(doc)) + width * doc
    index[place] = (keys % np.uint64(buckets)).astype(np.int64)
    values[place] = value
    place = (cuts[1:, None] - width + np.arange(width)).ravel()
    index[place] = np.tile(buckets + np.arange(width), texts)
    values[place] = np.stack(dense, 1).ravel() if texts else np.zeros(0)
    return cuts, index, values


@dataclass
class FactorisationMachine:
    """Weights of a fitted machine; ``v`` has a row of factors per feature."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, cuts: np.ndarray, index: np.ndarray, x: np.ndarray) -> np.ndarray:
        """One per text. Every text has at least its dense features, so no stretch is empty."""
        if len(cuts) < 2:
            return np.zeros(0)
        starts = cuts[:-1]
        vx = self.v[index] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        linear = np.add.reduceat(self.w[index] * x, starts)
        return self.w0 + linear + 0.5 * (sums**2 - squares).sum(1)

    def scores(self, cuts: np.ndarray, index: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(cuts, index, x), -40, 40)))


def train(
    cuts: np.ndarray,
    index: np.ndarray,
    x: np.ndarray,
    labels: np.ndarray,
    size: int,
    factors: int = FACTORS,
    epochs: int = 12,
    batch: int = 128,
    rate: float = 0.05,
    decay: float = 1e-4,
) -> FactorisationMachine:
    """Logistic loss, adaptive steps per weight (AdaGrad), fixed seed: equal input gives equal weights."""
    rng = np.random.default_rng(1)
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    fm = FactorisationMachine(
        float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, factors))
    )
    g0, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, factors), 1e-6)
    lengths = np.diff(cuts)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            n = lengths[rows]
            picked = np.repeat(cuts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own, i, xi = np.repeat(np.arange(len(rows)), n), index[picked], x[picked]
            inner = np.concatenate([[0], np.cumsum(n)])
            miss = fm.scores(inner, i, xi) - labels[rows]
            vx = fm.v[i] * xi[:, None]
            sums = np.add.reduceat(vx, inner[:-1], axis=0)
            scale = (miss / len(rows))[own] * xi
            dw = np.bincount(i, scale, size)
            met = np.unique(i)
            dv = np.zeros_like(fm.v)
            np.add.at(dv, i, scale[:, None] * (sums[own] - vx))
            d0 = miss.mean()
            dw[met] += decay * fm.w[met]
            dv[met] += decay * fm.v[met]
            g0 += d0 * d0
            gw[met] += dw[met] ** 2
            gv[met] += dv[met] ** 2
            fm.w0 -= rate * d0 / np.sqrt(g0)
            fm.w[met] -= rate * dw[met] / np.sqrt(gw[met])
            fm.v[met] -= rate * dv[met] / np.sqrt(gv[met])
    return fm


def held_out(key: Column) -> Column:
    """Whether a row's label must not be learnt from: checksum of the id's text divisible by five.

    A null id is held out.
    """
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _features_of(df: DataFrame, columns: list[str], meta: tuple[str, ...], buckets: int) -> DataFrame:
    """The columns, and the features of every row: for the rows the machine is fitted on."""
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, scan in scans(batch.column("_text")):
                rows = batch.slice(at, n)
                at += n
                cuts, index, values = features(scan, _meta(rows, meta), buckets)
                spans = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(c) for c in columns],
                        list_array([index[a:b] for a, b in spans], pa.int32()),
                        list_array([values[a:b] for a, b in spans], pa.float64()),
                    ],
                    names=[*columns, "index", "value"],
                )

    return df.transform(small_batches).mapInArrow(run, f"{kinds}, index array<int>, value array<double>")


def _meta(batch: pa.RecordBatch, meta: tuple[str, ...]) -> np.ndarray:
    if not meta:
        return np.zeros((batch.num_rows, 0))
    columns = [batch.column(f"_m{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(meta))]
    return np.stack(columns, 1)


def _inputs(text: str, meta: tuple[str, ...]) -> list[Column]:
    return [
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(meta)],
    ]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    meta: tuple[str, ...] = METADATA,
    buckets: int = BUCKETS,
    sample_limit: int = SAMPLE_LIMIT,
) -> FactorisationMachine:
    """Fit on at most ``sample_limit`` labelled rows that aren't held out, taken in hash order of the id.

    Rows whose label is null are not learnt from; an id with contradicting labels counts as bad. Of several
    rows under one id that with the smallest hash of its text is learnt, so the same rows give the same weights in every layout. Without any label
    nothing is learnt: scores are those of the small random weights the fit begins with.
    """
    usable = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id").agg(F.min("quality").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_limit)
        .withColumnRenamed("doc_id", "_chosen")
    )
    # At most sample_limit ids and labels. Inputs are named first, so no column of docs can clash.
    inputs = docs.select(F.col(key).alias("_key"), *_inputs(text, meta))
    rows = inputs.join(F.broadcast(chosen), F.col("_key") == F.col("_chosen")).select(
        "_key", F.col("_label").cast("double").alias("_label"), *inputs.columns[1:]
    )
    # One row per id, the same one whatever the layout: a hot id is cut to one row within each task.
    first = F.struct(F.xxhash64("_text").alias("_hash"), *rows.columns[1:])
    rows = rows.groupBy("_key").agg(F.min(first).alias("_first")).select("_key", "_first.*").drop("_hash")
    table = _features_of(rows, ["_key", "_label"], meta, buckets).toArrow()
    size = buckets + len(STRUCTURE) + 2 * len(meta)
    order = np.argsort(table.column("_key").to_numpy(), kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    index = table.column("index").combine_chunks()
    lengths = index.value_lengths().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    if isinstance(index, pa.ChunkedArray):
        index = pa.concat_arrays(index.chunks)
    values = table.column("value").combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    return train(
        cuts,
        index.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        values.flatten().to_numpy(zero_copy_only=False),
        table.column("_label").to_numpy(),
        size,
    )


def score(
    docs: DataFrame,
    model: FactorisationMachine,
    keep: list[str] = ("doc_id",),
    text: str = "text",
    meta: tuple[str, ...] = METADATA,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The columns ``keep`` and fm_score (0 to 1) of every row.

    Null and empty texts are scored by their structure (no words). Null metadata counts as what the
    text gives. Repeated rows get equal scores.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], *_inputs(text, meta))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, scan in scans(batch.column("_text")):
                rows = batch.slice(at, n)
                at += n
                found = model.scores(*features(scan, _meta(rows, meta), buckets))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in names], pa.array(found)], names=[*names, "fm_score"]
                )

    return source.transform(small_batches).mapInArrow(run, f"{kinds}, fm_score double").withColumnsRenamed(dict(zip(names, keep)))


@query("op10_factorisation_machine")
def op10_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality."""
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("fm_score").alias("score"),
        (F.col("fm_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
