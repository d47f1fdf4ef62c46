"""Hard-negative mining by angular triangle filtering.

Every row keeps its norm and its angles to a few reference directions. On the sphere the angle between an anchor and a row lies
between the difference and the sum of their angles to any reference, so the stored angles give an interval
of their cosine, and times both norms an interval of their score that is widened by more than all
rounding. Only pairs whose interval meets a window still open for the anchor get integer scoring:

1. positives: rows of the anchor's label whose upper bound reaches its fifth best score so far;
2. negatives: rows of other labels whose interval meets the window ``low * positive .. positive`` of one of
   its positives, where a window with enough negatives only stays open above the worst of them.

Rows are ordered by nearest reference and angle before they are cut into blocks, and a block whose
extreme angles rule out an anchor is skipped as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import query, read
from .vectors import Walk, in_blocks, matrix, query_batches, sample, search, spread, union, usable, widest

#: Reference directions, and the rows they are chosen from.
REFERENCES, REFERENCE_ROWS = 16, 2048
#: Factor from components to the integers that are scored.
SCALE = 256
#: Anchors whose bounds are computed at a time.
ANCHORS_AT_ONCE = 256
#: Added to angles and, per unit of both norms, to scores: far above the rounding of 32-bit numbers.
ANGLE_SLACK, SCORE_SLACK = 4e-6, 4e-6
#: Up to here doubles hold every integer, so sums of products are exact in any order.
EXACT = float(1 << 53)

NOTHING = np.iinfo(np.int64).min


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of every component, as doubles."""
    return np.floor(SCALE * vectors.astype(np.float64))


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(1))


def angles_to(vectors: np.ndarray, lengths: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of every row to every reference; a row of zeros scores 0 with all, so any angle will do."""
    cosines = (vectors @ references.T) / np.where(lengths > 0, lengths, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def choose_references(vectors: np.ndarray, count: int) -> np.ndarray:
    """Directions far from each other: each next row is the one furthest from all chosen before."""
    units = vectors[norms(vectors) > 0]
    units = units / norms(units)[:, None]
    if not len(units):
        return np.zeros((0, vectors.shape[1]))
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, units @ units[far])
    return units[chosen]


def score_bounds(angles_a, norms_a, angles_b, norms_b) -> tuple[np.ndarray, np.ndarray]:
    """(at least, at most) the score of every pair of a row of ``a`` and one of ``b``."""
    gap = np.zeros((len(angles_a), len(angles_b)), np.float32)
    total = np.full_like(gap, np.pi)
    for r in range(angles_a.shape[1]):
        one, other = angles_a[:, r, None], angles_b[None, :, r]
        np.maximum(gap, np.abs(one - other), out=gap)
        around = one + other
        np.minimum(total, np.minimum(around, np.float32(2 * np.pi) - around), out=total)
    return scaled_bounds(gap, total, norms_a[:, None] * norms_b[None, :])


def scaled_bounds(gap, total, product) -> tuple[np.ndarray, np.ndarray]:
    slack = SCORE_SLACK * product + 1e-3
    high = np.cos(np.maximum(gap - ANGLE_SLACK, 0)) * product + slack
    low = np.cos(np.minimum(total + ANGLE_SLACK, np.float32(np.pi))) * product - slack
    return low, high


def scores(rows: np.ndarray, anchor: np.ndarray, product: float) -> np.ndarray:
    """Integer inner products; ``product`` bounds their size. One that no long holds raises."""
    if product < EXACT:
        return (rows @ anchor).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(row, anchor)) for row in rows]
    return np.array(whole, np.int64)


def prepare(rows: DataFrame, dim: int, references: np.ndarray) -> DataFrame:
    """Rows with integer norms, angles and a place: blocks of rows near each other."""
    vec = rows.schema["vec"].dataType.simpleString()

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(matrix(batch.column(1), dim))
            angles = angles_to(whole, norms(whole), references)
            cell = angles.argmin(1) if angles.shape[1] else np.zeros(len(whole), np.int64)
            near = angles.min(1) if angles.shape[1] else np.zeros(len(whole), np.float32)
            extra = [pa.array(cell.astype(np.int32)), pa.array(near.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=["key", "vec", "label", "query", "cell", "near"])

    placed = rows.mapInArrow(measure, f"key long, vec {vec}, label long, query boolean, cell int, near float")
    place = ["cell", "near", "key"]
    ordered = placed.repartitionByRange(*place).sortWithinPartitions(*place)
    named = ordered.select("key", "vec", "label", "query", F.spark_partition_id().cast("long").alias("part"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for block in in_blocks(batches):
            vectors = matrix(block["vec"], dim)
            whole = integers(vectors)
            lengths = norms(whole)
            uids = (block["part"].to_numpy() << 40) + seen + np.arange(len(vectors))
            seen += len(vectors)
            columns = [
                uids,
                block["key"].to_numpy().astype(np.int64),
                block["label"].to_numpy().astype(np.int64),
                block["query"].to_numpy().astype(np.uint8),
                lengths,
                angles_to(whole, lengths, references),
                vectors,
            ]
            data = [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays([*data, pa.array([vectors.dtype.str])], names=[*PACKED, "kind"])

    return spread(named.mapInArrow(pack, ", ".join(f"{c} binary" for c in PACKED) + ", kind string"))


PACKED = ["uids", "keys", "labels", "queries", "norms", "angles", "vectors"]


def unpack(block: dict, dim: int) -> dict[str, np.ndarray]:
    count = len(block["uids"]) // 8
    kinds = dict(uids="<i8", keys="<i8", labels="<i8", queries="u1", norms="<f8", angles="<f4", vectors=block["kind"])
    out = {name: np.frombuffer(block[name], kind) for name, kind in kinds.items()}
    out["angles"] = out["angles"].reshape(count, -1)
    out["vectors"] = integers(out["vectors"].reshape(count, dim))
    return out


def anchors_of(blocks: DataFrame, dim: int) -> DataFrame:
    """The query rows of stored blocks."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = unpack(row, dim)
                at = np.flatnonzero(block["queries"])
                lists = [pa.array(list(block[c][at]), t) for c, t in (("vectors", pa.list_(pa.float64())), ("angles", pa.list_(pa.float32())))]
                plain = [pa.array(block[c][at]) for c in ("uids", "keys", "labels", "norms")]
                yield pa.RecordBatch.from_arrays([*plain, *lists], names=["uid", "key", "label", "norm", "vec", "angles"])

    return blocks.mapInArrow(pick, "uid long, key long, label long, norm double, vec array<double>, angles array<float>")


class Anchors:
    """A batch of anchors, and the positives found for them."""

    def __init__(self, found: pa.Table, dim: int, references: int):
        self.uids, self.keys, self.labels = (found[c].to_numpy() for c in ("uid", "key", "label"))
        self.norms = found["norm"].to_numpy()
        self.vectors = matrix(found["vec"], dim) if len(found) else np.zeros((0, dim))
        self.angles = matrix(found["angles"], references) if len(found) else np.zeros((0, references), np.float32)

    def reachable(self, block: dict) -> tuple[np.ndarray, np.ndarray]:
        """(at least, at most) the score of every anchor with any row of a block, by the block's extreme angles."""
        low, high = block["angles"].min(0), block["angles"].max(0)
        gap = np.maximum(np.maximum(self.angles - high, low - self.angles), 0)
        around = self.angles + high
        total = np.where(around < np.pi, around, np.pi)  # beyond the pole the sum bounds nothing for all rows
        count = len(self.angles)
        gap = gap.max(1) if gap.shape[1] else np.zeros(count, np.float32)
        total = total.min(1) if total.shape[1] else np.full(count, np.pi, np.float32)
        most, least = block["norms"].max(), block["norms"].min()
        # A negative cosine gives the smallest score with the largest norm, a positive one with the smallest.
        upper = np.maximum(*(scaled_bounds(gap, total, self.norms * n)[1] for n in (most, least)))
        lower = np.minimum(*(scaled_bounds(gap, total, self.norms * n)[0] for n in (most, least)))
        return lower, upper


def best(score: np.ndarray, key: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count``: highest score first, ties by smaller key."""
    if len(score) > 4 * count:
        least = np.partition(score, len(score) - count)[len(score) - count]
        at = np.flatnonzero(score >= least)
        return at[np.lexsort((key[at], -score[at]))[:count]]
    return np.lexsort((key, -score))[:count]


class Positives(Walk):
    """The best rows of every anchor's label."""

    def __init__(self, anchors: Anchors, dim: int, count: int):
        self.anchors, self.dim, self.count = anchors, dim, count
        self.found = [(np.zeros(0, np.int64),) * 3] * len(anchors.uids)  # (score, key, uid)
        self.worst = np.full(len(anchors.uids), -np.inf)

    def see(self, block: dict) -> None:
        rows, anchors = unpack(block, self.dim), self.anchors
        open_ = (anchors.reachable(rows)[1] >= self.worst) & np.isin(anchors.labels, rows["labels"])
        at = np.flatnonzero(open_)
        for label in np.unique(anchors.labels[at]):
            mine = np.flatnonzero(rows["labels"] == label)
            ours = at[anchors.labels[at] == label]
            for lo in range(0, len(ours), ANCHORS_AT_ONCE):
                part = ours[lo : lo + ANCHORS_AT_ONCE]
                _, high = score_bounds(anchors.angles[part], anchors.norms[part], rows["angles"][mine], rows["norms"][mine])
                wanted = (high >= self.worst[part, None]) & (rows["uids"][mine] != anchors.uids[part, None])
                for a, hits in zip(part, wanted):
                    if hits.any():
                        self.add(a, rows, mine[hits])

    def add(self, a: int, rows: dict, at: np.ndarray) -> None:
        size = self.anchors.norms[a] * rows["norms"][at].max()
        scored = scores(rows["vectors"][at], self.anchors.vectors[a], size)
        old = self.found[a]
        joined = [np.concatenate(x) for x in zip(old, (scored, rows["keys"][at], rows["uids"][at]))]
        keep = best(joined[0], joined[1], self.count)
        self.found[a] = tuple(x[keep] for x in joined)
        if len(keep) == self.count:
            self.worst[a] = self.found[a][0][-1]

    def result(self) -> Iterator[pa.RecordBatch]:
        sizes = [len(f[0]) for f in self.found]
        if sum(sizes):
            score, key, uid = (np.concatenate(x) for x in zip(*self.found))
            owner = np.repeat(self.anchors.uids, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (owner, score, key, uid)], names=["anchor", "score", "key", "uid"])


class Negatives(Walk):
    """For every anchor and positive, the best rows of other labels within the positive's window."""

    def __init__(self, anchors: Anchors, dim: int, count: int, share: int, positives: dict[int, list[tuple[int, int, int]]]):
        self.anchors, self.dim, self.count, self.share = anchors, dim, count, share
        most = max(map(len, positives.values()), default=0)
        size = len(anchors.uids)
        # Windows as matrices, one column per positive; a missing one is empty.
        self.top = np.full((size, most), NOTHING, np.int64)
        self.base = np.full((size, most), np.iinfo(np.int64).max, np.int64)
        self.keys = np.zeros((size, most), np.int64)
        for a, uid in enumerate(anchors.uids.tolist()):
            for p, (score, key, _) in enumerate(positives.get(uid, ())):
                if score >= 0:  # below zero the window is empty
                    self.top[a, p], self.base[a, p], self.keys[a, p] = score, -(-share * score // 100), key
        self.floor = self.base.astype(np.float64)
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def see(self, block: dict) -> None:
        rows, anchors = unpack(block, self.dim), self.anchors
        lower, upper = anchors.reachable(rows)
        open_ = ((lower[:, None] <= self.top) & (upper[:, None] >= self.floor)).any(1)
        at = np.flatnonzero(open_)
        for lo in range(0, len(at), ANCHORS_AT_ONCE):
            part = at[lo : lo + ANCHORS_AT_ONCE]
            low, high = score_bounds(anchors.angles[part], anchors.norms[part], rows["angles"], rows["norms"])
            wanted = np.zeros(low.shape, bool)
            for p in range(self.top.shape[1]):
                wanted |= (low <= self.top[part, p, None]) & (high >= self.floor[part, p, None])
            wanted &= rows["labels"] != anchors.labels[part, None]
            for a, hits in zip(part, wanted):
                if hits.any():
                    self.add(a, rows, np.flatnonzero(hits))

    def add(self, a: int, rows: dict, at: np.ndarray) -> None:
        size = self.anchors.norms[a] * rows["norms"][at].max()
        scored = scores(rows["vectors"][at], self.anchors.vectors[a], size)
        keys = rows["keys"][at]
        inside = (scored >= self.floor[a].min()) & (scored <= self.top[a].max())
        scored, keys = scored[inside], keys[inside]
        for p in range(self.top.shape[1]):
            hits = (scored >= self.floor[a, p]) & (scored <= self.top[a, p])
            if not hits.any():
                continue
            score, key = scored[hits], keys[hits]
            if (a, p) in self.found:
                score, key = np.append(self.found[a, p][0], score), np.append(self.found[a, p][1], key)
            keep = best(score, key, self.count)
            self.found[a, p] = score[keep], key[keep]
            if len(keep) == self.count:
                self.floor[a, p] = score[keep[-1]]

    def result(self) -> Iterator[pa.RecordBatch]:
        if not self.found:
            return
        places = list(self.found)
        sizes = [len(self.found[x][0]) for x in places]
        a, p = (np.repeat(np.array(x, np.int64), sizes) for x in zip(*places))
        score, key = (np.concatenate(x) for x in zip(*self.found.values()))
        columns = [self.anchors.uids[a], p, self.anchors.keys[a], self.keys[a, p], self.top[a, p], score, key]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in MINED.split(", ")])


MINED = "anchor long, place long, anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long"


def first_of(df: DataFrame, by: list[str], score: str, key: str, count: int) -> DataFrame:
    """The first ``count`` rows of every group with their ``rank``: few per task and group come in."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), key)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors, by the table's columns. A score is the inner product of floor(256 * x). An anchor's positives
    are the first ``positives`` other rows of its label by score, ties by smaller key; its negatives for a positive
    the first ``negatives`` rows of other labels with ``share`` % of the positive's score or more, but not more than all of it.

    Rows without key, label or vector, or with a component that is null or not finite, take no part. Shorter
    vectors count as if zeros followed. Repeated rows are rows of their own: a copy of an anchor is one of
    its positives, and each repeated anchor has its own rows. Anchors without positives or negatives have no rows; an
    empty table gives none. A score that no 64-bit integer holds raises.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(df, key, vector, {"label": label.cast("long"), "query": F.coalesce(anchors, F.lit(False))})
    rows = rows.where(F.col("label").isNotNull())
    dim = widest(rows)
    taken = sample(rows.select("key", "vec"), REFERENCE_ROWS)
    references = choose_references(integers(matrix(taken["vec"], dim)), REFERENCES) if len(taken) else np.zeros((0, dim))
    blocks = prepare(rows, dim, references)
    columns = [*PACKED, "kind"]
    sc, mined = df.sparkSession.sparkContext, []
    for found in query_batches(materialize(anchors_of(blocks, dim))):
        sent = sc.broadcast(Anchors(found, dim, len(references)))

        def positives_walk(sent=sent) -> Walk:
            return Positives(sent.value, dim, positives)

        best_rows = search(blocks, columns, "anchor long, score long, key long, uid long", positives_walk)
        best_rows = first_of(best_rows, ["anchor"], "score", "key", positives).orderBy("anchor", "rank")
        per_anchor: dict[int, list[tuple[int, int, int]]] = {}
        for row in best_rows.select("anchor", "score", "key", "uid").toArrow().to_pylist():
            per_anchor.setdefault(row["anchor"], []).append((row["score"], row["key"], row["uid"]))
        windows = sc.broadcast(per_anchor)

        def negatives_walk(sent=sent, windows=windows) -> Walk:
            return Negatives(sent.value, dim, negatives, share, windows.value)

        hits = search(blocks, columns, MINED, negatives_walk)
        mined.append(materialize(first_of(hits, ["anchor", "place"], "negative_score", "negative_id", negatives)))
    if not mined:
        return df.sparkSession.createDataFrame([], RESULT)
    return union(mined).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every hundredth vector; every seventh vector has a wrong label."""
    wrong = F.col("vec_id") % 7 == 0
    label = F.when(wrong, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)
