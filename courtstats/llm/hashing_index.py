"""Approximate nearest neighbours by multi-index hashing.

A vector's code has 256 bits: signs of its coordinates after rotations that iterative quantization learns on a bounded
sample. Codes are cut into 16 substrings of 16 bits. Every row is indexed: a block holds its codes and, per substring,
its rows in the order of the substring's values. A query has a Hamming radius; by the pigeonhole principle a code
within it differs from the query's in at most a share of the radius in one of the substrings, so probing the buckets
of all values that near retrieves every code within the radius. Retrieved codes are checked against the radius, and the
rows left are ranked by their exact cosine.

The radius belongs to the query: the sample shows a cosine that five of its rows reach, so the nearest rows
reach it too; their angle's expected distance plus a slack learned from close pairs of the sample is the radius,
at least the distance of those five. In every task it shrinks with the best rows found so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import query, read
from .hard_negatives import best, first_of, norms
from .vectors import Walk, in_blocks, matrix, query_batches, sample, search, spread, union, usable, widest

#: Bits of a code and of a substring.
BITS, SUBSTRING = 256, 16
PARTS = BITS // SUBSTRING
#: Rows on which the rotations and the radius are fitted.
SAMPLE_ROWS = 4096
#: Share of the sample's close pairs whose distance the slack of the radius covers.
COVERED = 0.99
STEPS = 30


# --- Codes ------------------------------------------------------------------------------


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows as doubles, each times a power of two that brings its largest component near 1.

    Cosines keep every bit, and squares of very large or small components neither overflow nor vanish.
    """
    doubles = vectors.astype(np.float64)
    _, power = np.frexp(np.abs(doubles).max(1, initial=0))
    return np.ldexp(doubles, -power[:, None])


def units_of(vectors: np.ndarray) -> np.ndarray:
    doubles = scaled(vectors)
    return doubles / norms(doubles)[:, None]


def learn_rotations(units: np.ndarray, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """Columns of rotations one after the other, until there are enough for all bits.

    Each starts at random; a step takes the signs of the rotated sample as the targets and finds the rotation that
    comes closest to them (an orthogonal Procrustes problem). Vectors wider than the code are first turned
    to their main axes.
    """
    dim = units.shape[1]
    rng = np.random.default_rng(seed)
    axes = np.eye(dim)
    if dim > bits:
        _, vectors = np.linalg.eigh(units.T @ units)
        axes = vectors[:, ::-1][:, :bits]
    seen = units @ axes
    out = []
    while sum(r.shape[1] for r in out) < bits:
        turn, _ = np.linalg.qr(rng.standard_normal((seen.shape[1],) * 2))
        for _ in range(STEPS):
            left, _, right = np.linalg.svd(seen.T @ np.where(seen @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        out.append(axes @ turn)
    return np.concatenate(out, 1)[:, :bits]


def codes_of(units: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """A row of 16-bit substrings per vector."""
    return np.packbits(units @ rotations >= 0, axis=1, bitorder="little").view("<u2")


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hamming distance of every code to one, or row by row to as many."""
    words = np.ascontiguousarray(codes).view("<u8"), np.ascontiguousarray(code).view("<u8")
    return np.bitwise_count(words[0] ^ words[1]).sum(-1, dtype=np.int64)


@lru_cache(maxsize=SUBSTRING + 1)
def masks(radius: int) -> np.ndarray:
    """All 16-bit values with at most ``radius`` bits."""
    every = np.arange(1 << SUBSTRING, dtype=np.uint16)
    return every[np.bitwise_count(every) <= radius]


def part_radii(radius: int) -> list[int]:
    """How far each substring is probed: were all of them further off, the code would be outside the radius.

    With radius = PARTS * t + a, one of the first a + 1 substrings is within t or one of the rest within t - 1.
    """
    near, rest = divmod(radius, PARTS)
    return [near] * (rest + 1) + [near - 1] * (PARTS - rest - 1)


class Fit:
    """Rotations, the sample with its codes, and the rule for the radius."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.units = units_of(vectors)
        self.rotations = learn_rotations(self.units, seed=seed)
        self.codes = codes_of(self.units, self.rotations)
        self.slack = self._slack()

    def _slack(self, neighbours: int = 10) -> float:
        """By how much distances of close pairs exceed those that their angles let expect."""
        over = []
        for row in range(0, len(self.units), max(1, len(self.units) // 512)):
            cosines = self.units @ self.units[row]
            cosines[row] = -np.inf
            at = np.argsort(-cosines)[:neighbours]
            at = at[np.isfinite(cosines[at])]
            over.append(distances(self.codes[at], self.codes[row]) - expected(cosines[at]))
        found = np.concatenate(over) if over else np.zeros(0)
        return float(np.quantile(found, COVERED)) if len(found) else float(BITS)

    def radius(self, cosine: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(expected(cosine) + self.slack), 0, BITS).astype(np.int64)

    def first_radius(self, unit: np.ndarray, code: np.ndarray, wanted: int, own: bool) -> int:
        """Radius for a query that the sample sets; ``own`` says that the query is a row of the sample."""
        cosines = self.units @ unit
        at = np.argsort(-cosines)[: wanted + own]
        if len(at) < wanted + own:
            return BITS
        return max(int(self.radius(cosines[at[-1:]])[0]), int(distances(self.codes[at], code).max()))


def expected(cosine: np.ndarray) -> np.ndarray:
    """Bits in which codes at this cosine differ on average."""
    return BITS * np.arccos(np.clip(cosine, -1, 1)) / np.pi


# --- Index ------------------------------------------------------------------------------

INDEXED = ["uids", "keys", "queries", "vectors", "codes", "orders"]


def build(rows: DataFrame, dim: int, fit: Fit) -> DataFrame:
    """The index: every row in a block, with its code and its place in the order of each substring."""
    sent = rows.sparkSession.sparkContext.broadcast(fit.rotations)
    named = rows.select("key", "vec", "query", F.spark_partition_id().cast("long").alias("part"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for block in in_blocks(batches):
            vectors = matrix(block["vec"], dim)
            codes = codes_of(units_of(vectors), sent.value)
            uids = (block["part"].to_numpy() << 40) + seen + np.arange(len(vectors))
            seen += len(vectors)
            columns = [
                uids,
                block["key"].to_numpy().astype(np.int64),
                block["query"].to_numpy().astype(np.uint8),
                vectors,
                codes,
                np.argsort(codes, axis=0, kind="stable").T.astype(np.uint16),
            ]
            data = [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays([*data, pa.array([vectors.dtype.str])], names=[*INDEXED, "kind"])

    return spread(named.mapInArrow(pack, ", ".join(f"{c} binary" for c in INDEXED) + ", kind string"))


class Block:
    """An indexed block."""

    def __init__(self, block: dict, dim: int):
        self.uids, self.keys = np.frombuffer(block["uids"], "<i8"), np.frombuffer(block["keys"], "<i8")
        self.queries = np.frombuffer(block["queries"], "u1")
        count = len(self.uids)
        self.vectors = scaled(np.frombuffer(block["vectors"], block["kind"]).reshape(count, dim))
        self.lengths = norms(self.vectors)
        self.codes = np.frombuffer(block["codes"], "<u2").reshape(count, PARTS)
        self.orders = np.frombuffer(block["orders"], "<u2").reshape(PARTS, count)
        self.sorted = np.take_along_axis(self.codes.T, self.orders.astype(np.int64), 1)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes within the radius: buckets by substring, then the whole code."""
        met = np.zeros(len(self.uids), bool)
        for part, near in enumerate(part_radii(radius)):
            if near < 0:
                continue
            values = self.sorted[part]
            probes = masks(min(near, SUBSTRING))
            if 8 * len(probes) < len(values):
                wanted = probes ^ code[part]
                starts = np.searchsorted(values, wanted, "left")
                for lo, hi in zip(starts, np.searchsorted(values, wanted, "right")):
                    met[self.orders[part, lo:hi]] = True
            else:  # fewer buckets than probes: look at the buckets' values instead
                met[self.orders[part][np.bitwise_count(values ^ code[part]) <= near]] = True
        at = np.flatnonzero(met)
        return at[distances(self.codes[at], code) <= radius]


class Queries:
    """A batch of queries with their first radii."""

    def __init__(self, found: pa.Table, dim: int):
        self.uids, self.keys, self.radii = (found[c].to_numpy() for c in ("uid", "key", "radius"))
        self.vectors = matrix(found["vec"], dim)
        self.lengths = norms(self.vectors)
        self.codes = np.frombuffer(b"".join(found["code"].to_pylist()), "<u2").reshape(-1, PARTS)


class Nearest(Walk):
    """The nearest rows of every query among those within its radius."""

    def __init__(self, queries: Queries, dim: int, fit_radius, count: int):
        self.queries, self.dim, self.count, self.fit_radius = queries, dim, count, fit_radius
        self.radii = queries.radii.copy()
        self.found = [(np.zeros(0), np.zeros(0, np.int64))] * len(queries.uids)

    def see(self, block: dict) -> None:
        rows, queries = Block(block, self.dim), self.queries
        for q in range(len(queries.uids)):
            at = rows.within(queries.codes[q], int(self.radii[q]))
            at = at[rows.uids[at] != queries.uids[q]]
            if not len(at):
                continue
            # One order of additions for every row, so copies of a vector tie exactly.
            cosine = (rows.vectors[at] * queries.vectors[q]).sum(1) / (rows.lengths[at] * queries.lengths[q])
            score, key = np.append(self.found[q][0], cosine), np.append(self.found[q][1], rows.keys[at])
            keep = best(score, key, self.count)
            self.found[q] = score[keep], key[keep]
            if len(keep) == self.count:
                now = int(self.fit_radius(score[keep[-1:]])[0])
                self.radii[q] = min(self.radii[q], now)

    def result(self) -> Iterator[pa.RecordBatch]:
        sizes = [len(f[0]) for f in self.found]
        if sum(sizes):
            score, key = (np.concatenate(x) for x in zip(*self.found))
            uid, own = np.repeat(self.queries.uids, sizes), np.repeat(self.queries.keys, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid, own, score, key)], names=["uid", "query_id", "score", "vec_id"])


def queries_of(blocks: DataFrame, dim: int, fit, wanted: int) -> DataFrame:
    """The query rows of the index, each with its code and its first radius."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {row.tobytes() for row in fit.value.units}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, dim)
                at = np.flatnonzero(block.queries)
                units = units_of(block.vectors[at])
                codes = block.codes[at]
                radii = [fit.value.first_radius(u, c, wanted, u.tobytes() in known) for u, c in zip(units, codes)]
                columns = [
                    pa.array(block.uids[at]),
                    pa.array(block.keys[at]),
                    pa.array(radii, pa.int64()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(list(block.vectors[at]), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "key", "radius", "code", "vec"])

    return blocks.mapInArrow(pick, "uid long, key long, radius long, code binary, vec array<double>")


FOUND = "query_id long, rank int, vec_id long, score double"


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", count: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``count`` rows nearest to every query by cosine that the index finds.

    ``queries`` says which rows are queries, by the table's columns; all other rows and the other queries are
    candidates. Scores are exact; ties go to the smaller key. Which rows are found is approximate: a true neighbour is
    missed if its code lies outside the query's radius. With no more candidates than ``count``, all are found.

    Rows without key, and vectors that are null, zero, or hold a component that is null or not finite, take no part.
    Shorter vectors count as if zeros followed. Repeated rows are rows of their own: a copy of a query is a
    candidate, and each repeated query has its own rows. An empty table, or one without queries, gives no rows.
    """
    rows = usable(df, key, vector, {"query": F.coalesce(queries, F.lit(False))})
    rows = rows.where(F.exists("vec", lambda x: x != 0))
    dim = widest(rows)
    spark = df.sparkSession
    if dim == 0:
        return spark.createDataFrame([], FOUND)
    fit = Fit(matrix(sample(rows.select("key", "vec"), SAMPLE_ROWS)["vec"], dim))
    sent = spark.sparkContext.broadcast(fit)
    index = build(rows, dim, fit)
    parts = []
    for found in query_batches(materialize(queries_of(index, dim, sent, count))):
        batch = spark.sparkContext.broadcast(Queries(found, dim))

        def walk(batch=batch) -> Walk:
            return Nearest(batch.value, dim, sent.value.radius, count)

        hits = search(index, [*INDEXED, "kind"], "uid long, query_id long, score double, vec_id long", walk)
        parts.append(materialize(first_of(hits, ["uid"], "score", "vec_id", count)))
    if not parts:
        return spark.createDataFrame([], FOUND)
    return union(parts).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op12_nearest_neighbours")
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every fiftieth vector."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
