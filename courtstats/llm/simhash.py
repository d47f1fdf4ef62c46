"""SimHash near-duplicates through Burkhard-Keller trees.

A fingerprint takes the majority of the bits of all shingle hashes. Distinct fingerprints are dealt to
shards: 64 bits are cut into one block more than the radius, so two fingerprints within
the radius agree in at least one block, and all that agree in a block form a shard. A shard's tree keys
children by their integer Hamming distance to the parent; a search follows only edges within the radius
of the query's distance (triangle inequality). A shard leaves its task as one star of links, not as pairs.

Shards above ``shard_limit`` members would make one slow task. They are cut again in the same way on the
bits their members needn't agree in, so chance agreement (at a billion fingerprints nearly every first
shard) still goes through trees. What is above the limit after that is a dense group of near copies,
whose members agree in nearly all bits. It is linked by an exact way that splits: every member names all
values within one flipped bit of it; two fingerprints within two bits of each other name a common value, and
all that name one value are within two bits of each other. At most 65 fingerprints can name a value.

All trees together have no size bound, so they aren't broadcast: a shard's members and its tree meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize

from .bpe import text_blocks
from .common import query, read, small, small_batches
from .components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Members up to which a shard is searched by its tree in one task.
SHARD_LIMIT = 512
_LANES = np.uint64(0x0101010101010101)


# --- Fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: str, width: int = SHINGLE) -> list[int]:
    """XXH64 of all word shingles, repeats included; fewer words: of the whole sequence; none: none."""
    # bytes.lower folds A-Z only, and bytes.split cuts at just the six ASCII white-space bytes.
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) < width:
        return [digest(joined, SEED)] if parts else []
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - width + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes the bits set in over half of them; an empty run gives zero.

    Eight bits are counted at a time, one in each byte of a word, over at most 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    starts = np.cumsum(sizes) - sizes
    pieces = -(-sizes // 255)
    owner = np.repeat(np.arange(len(full)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = starts[owner] + 255 * nth
    first = np.cumsum(pieces) - pieces
    bits = np.zeros(len(full), np.uint64)
    for k in range(8):
        lanes = (hashes >> np.uint64(k)) & _LANES
        sums = np.add.reduceat(lanes, cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums, first, axis=0, dtype=np.int64)
        over = (2 * totals > sizes[:, None]).astype(np.uint64)
        for j in range(8):
            bits |= over[:, j] << np.uint64(8 * j + k)
    out[full] = bits
    return out


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, version, fp) of every row: fp as a signed 64-bit integer, version = xxhash64 of the text.

    Null and blank texts have fingerprint zero. Other columns are dropped; a row is taken by itself.
    """
    source = df.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column("text")):
                rows = batch.slice(at, len(block))
                at += len(block)
                lists = [shingle_hashes(t) for t in block]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter((h for hs in lists for h in hs), np.uint64, int(counts.sum()))
                made = majority_bits(flat, counts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), rows.column("version"), pa.array(made)],
                    names=["key", "version", "fp"],
                )

    return source.transform(small_batches).mapInArrow(run, f"key {kind}, version long, fp long").withColumnRenamed("key", key)


# --- Trees ------------------------------------------------------------------------------


class BKTree:
    """Burkhard-Keller tree over integers under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Indexes of all values at most ``radius`` bits away."""
        found, stack = [], [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            edges = self.children[node]
            for e in range(d - radius, d + radius + 1):
                if e in edges:
                    stack.append(edges[e])
        return found

    def add(self, value: int) -> None:
        """Insert a value that isn't in the tree yet."""
        if self.values:
            node = 0
            while True:
                d = (self.values[node] ^ value).bit_count()
                below = self.children[node].get(d)
                if below is None:
                    self.children[node][d] = len(self.values)
                    break
                node = below
        self.values.append(value)
        self.children.append({})


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect just what the pairs within the radius connect: one star per group."""
    tree, root = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
        tree.add(value)
    return [(values[i], values[top(i)]) for i in range(len(values)) if top(i) != i]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def cut_masks(mask: int, radius: int) -> list[int]:
    """The mask widened by each of ``radius`` + 1 equal runs of its free bits.

    Values that agree under the mask and lie within the radius agree under at least one of these.
    """
    free = [i for i in range(64) if not mask >> i & 1]
    edges = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(edges, edges[1:])]


def _sharded(members: DataFrame, masks: Column) -> DataFrame:
    """(mask, value, fp, n) of all shards of two or more members; ``masks`` lists the masks to deal a row by."""
    keyed = members.select("fp", F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
    )
    sizes = keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return keyed.join(sizes, ["mask", "value"])


def _mask_list(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def links_within(fps: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` within the radius.

    ``fps`` holds distinct values. A dense group above the limit needs radius 2 or less.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the exact way for large shards covers a radius of at most 2")
    first = cut_masks(0, radius)
    shards = _sharded(fps, _mask_list(first))
    large = shards.where(F.col("n") > shard_limit).select("mask", "fp")
    again = F.coalesce(
        *[F.when(F.col("mask") == _signed(m), _mask_list(cut_masks(m, radius))) for m in first]
    )
    cut = _sharded(large, again)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; a shard may run on from one batch into the next."""
        shard, members = None, []

        def links(done: list[int]) -> list[tuple[int, int]]:
            unsigned = [v & 0xFFFFFFFFFFFFFFFF for v in done]
            return [(_signed(a), _signed(b)) for a, b in shard_links(unsigned, radius)]

        def batch_of(pairs):
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())}
            )

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("mask", "value", "fp"))
            for mask, value, fp in zip(*columns):
                if (mask, value) != shard:
                    out += links(members)
                    shard, members = (mask, value), []
                members.append(fp)
            yield batch_of(out)
        yield batch_of(links(members))

    by_tree = (
        shards.union(cut)
        .where(F.col("n") <= shard_limit)
        .select("mask", "value", "fp")
        .repartition("mask", "value")
        .sortWithinPartitions("mask", "value", "fp")
        .transform(small_batches).mapInArrow(search, "a long, b long")
    )
    every_bit = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    named = (
        cut.where(F.col("n") > shard_limit)
        .select("fp")
        .distinct()
        .select("fp", F.explode(every_bit).alias("bit"))
        .select(F.col("fp").bitwiseXOR(F.col("bit")).alias("near"), "fp")
    )
    if radius < 2:
        # Flips link up to two bits; a smaller radius links only the value itself and its neighbours.
        by_flip = named.where(F.lit(radius == 1)).join(fps.select(F.col("fp").alias("near")), "near").select(
            F.col("fp").alias("a"), F.col("near").alias("b")
        )
    else:
        met = named.groupBy("near").agg(F.collect_list("fp").alias("group")).where(F.size("group") > 1)
        by_flip = met.select(
            F.explode("group").alias("a"), F.array_min("group").alias("b")
        )
    return by_tree.union(by_flip).where("a <> b")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shard_limit: int = SHARD_LIMIT
) -> DataFrame:
    """(key, version, fp, component) of every row; component is the smallest key reachable by links.

    Rows with equal fingerprints are linked, so all blank texts are one group. Null keys belong to a
    group but never name it; a group without any key has a null component. Repeated rows stay.
    """
    return _groups(df, key, text, radius, shard_limit).drop("root")


def _groups(df: DataFrame, key: str, text: str, radius: int, shard_limit: int) -> DataFrame:
    """The rows of :func:`near_duplicates` with ``root``, a fingerprint that names the group."""
    marked = materialize(fingerprints(df, key, text))
    distinct = materialize(marked.groupBy("fp").agg(F.min(key).alias("low")))
    roots = components(links_within(distinct.select("fp"), radius, shard_limit))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(lowest, "root").select("fp", "component", "root")
    return marked.join(named, "fp").select(key, "version", "fp", "component", "root")


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shard_limit: int = SHARD_LIMIT
) -> DataFrame:
    """One row of every group: that with the smallest key; of rows that share it, one. A group without keys keeps one.

    The rows to drop are found on narrow columns (key and hash of the text); texts are only
    filtered.
    """
    found = _groups(df, key, text, radius, shard_limit).withColumnRenamed(key, "id")
    # Rows of one key count as one group; rows without a key go by the group's fingerprint.
    groups = materialize(found.withColumn("root", F.when(F.col("component").isNull(), F.col("root"))))
    keeps = F.col("id").eqNullSafe(F.col("component"))
    # The rare rest: several rows of a group that carry its smallest key, or no key. One text is kept, once.
    crowded = small(
        groups.where(keeps)
        .groupBy(F.col("id").alias("kept_id"), F.col("root").alias("kept_root"))
        .agg(F.count("*").alias("rows"), F.min("version").alias("kept"))
        .where(F.col("rows") > 1)
    )
    crowd = F.col("id").eqNullSafe(F.col("kept_id")) & F.col("root").eqNullSafe(F.col("kept_root"))
    others = groups.where(keeps).join(crowded, crowd & (F.col("version") != F.col("kept")))
    going = small(groups.where(~keeps).select("id", "version").union(others.select("id", "version")).distinct())
    version = F.xxhash64(df[text])
    left = df.join(going, df[key].eqNullSafe(going["id"]) & (version == going["version"]), "left_anti")
    here = df[key].eqNullSafe(crowded["kept_id"]) & (version == crowded["kept"])
    chosen = left.join(crowded, here, "left_semi").dropDuplicates([key, text])
    return left.join(crowded, here, "left_anti").unionByName(chosen)


@query("op2_simhash_groups")
def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    groups = near_duplicates(read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
