"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes of a text.

Tokenizer A is a byte-level tokenizers file and reads a space and the text; tokenizer B is a
sentencepiece model and adds that space itself. Both id lists get cumulative byte ends; a dictionary
from end to index per list, the intersection of their keys in order, and every two neighbouring common ends cut
one slice out of each list: a group. All pairs of an A and a B token of one group are links.

A text is aligned unit by unit. A unit ends where A's pattern starts a new piece behind a character that isn't
white space, and where no piece of B's vocabulary holds the two characters around that place next to each
other. A's pattern looks back at nothing and ahead only over white space, and B only merges into pieces of its vocabulary, so both
lists have an end there whatever else the text holds, and a unit has the same groups in every text.
Units met before come from a bounded cache of the worker.

Counts over the corpus (in how many documents an id pair is linked) are one aggregate over the documents' distinct
pairs. The most frequent pairs, at most ``HOT_PAIRS``, are sent to every task; documents meet the
counts of all other pairs in a shuffled join, where no pair is frequent any more.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize, new_folder

from .bpe import BLANK, SPACE, boundaries, class_table, ragged, text_blocks
from .common import query, read, small, small_batches
from .token_files import library_path

#: Pairs whose counts are sent to every task: two numbers and a flag each.
HOT_PAIRS = 400_000
#: Units a worker keeps, about 400 bytes each, and the longest one it keeps.
CACHE_UNITS, CACHED_LENGTH = 350_000, 40
#: Share of unknown units in a block above which a full cache is emptied; below, it stays as it is.
STALE = 0.4
#: Stands for a space in B's pieces.
SPACE_SIGN = "\u2581"
#: Bytes of a text whose ends are held in dictionaries at a time.
WINDOW = 1 << 20

# --- Slicing ----------------------------------------------------------------------------


def common_ends(a_ends: Sequence[int], b_ends: Sequence[int]) -> Iterator[tuple[int, int]]:
    """For every end that both ascending lists hold, in order: (tokens of A up to it, tokens of B up to it).

    An end that repeats (a token without bytes) counts with its last token. The dictionaries hold a
    window of bytes at a time, so a very long text needs no large ones.
    """
    a_at = b_at = 0
    while a_at < len(a_ends) and b_at < len(b_ends):
        limit = max(a_ends[a_at], b_ends[b_at]) + WINDOW
        a_stop, b_stop = bisect_right(a_ends, limit, a_at), bisect_right(b_ends, limit, b_at)
        a_index = {end: n for n, end in enumerate(a_ends[a_at:a_stop], a_at + 1)}
        b_index = {end: n for n, end in enumerate(b_ends[b_at:b_stop], b_at + 1)}
        for end in sorted(a_index.keys() & b_index.keys()):
            yield a_index[end], b_index[end]
        a_at, b_at = a_stop, b_stop


def groups_of(
    a_ids: Sequence[int], a_sizes: Sequence[int], b_ids: Sequence[int], b_sizes: Sequence[int]
) -> list[tuple[Sequence[int], Sequence[int]]]:
    """The two id lists cut at their common byte ends: one pair of slices per group."""
    out, a_from, b_from = [], 0, 0
    for a_to, b_to in common_ends(list(accumulate(a_sizes)), list(accumulate(b_sizes))):
        out.append((a_ids[a_from:a_to], b_ids[b_from:b_to]))
        a_from, b_from = a_to, b_to
    return out


def links_of(groups: Iterable[tuple[Sequence[int], Sequence[int]]]) -> dict[int, int]:
    """Links of every id pair (A id times 2^32 plus B id): those of a slice are products of its ids' counts."""
    links: dict[int, int] = {}
    for a_slice, b_slice in groups:
        if len(a_slice) * len(b_slice) <= 64:
            for a in a_slice:
                for b in b_slice:
                    links[a << 32 | b] = links.get(a << 32 | b, 0) + 1
            continue
        b_counts = Counter(b_slice)
        for a, times in Counter(a_slice).items():
            for b, more in b_counts.items():
                links[a << 32 | b] = links.get(a << 32 | b, 0) + times * more
    return links


def as_text(groups: Iterable[tuple[Sequence[int], Sequence[int]]]) -> str:
    """``a1,a2|b1;a3|b2,b3``."""
    return ";".join(
        [
            f"{a[0]}|{b[0]}" if len(a) == len(b) == 1 else f"{','.join(map(str, a))}|{','.join(map(str, b))}"
            for a, b in groups
        ]
    )


# --- Tokenizers -------------------------------------------------------------------------


class Results:
    """What is known of units, in flat arrays: groups as text, sums, and linked pairs with their links."""

    def __init__(self):
        self.texts: list[str] = []
        self.pairs, self.times = array("q"), array("q")
        self.ends, self.sums = array("q", [0]), array("q")

    def add(self, groups: list[tuple[list[int], list[int]]], sums: tuple[int, int, int, int]) -> None:
        links = links_of(groups)
        self.texts.append(as_text(groups))
        self.pairs.extend(links)
        self.times.extend(links.values())
        self.ends.append(len(self.pairs))
        self.sums.extend(sums)


class Pair:
    """Both tokenizers with the bytes of their tokens, and the cache of units."""

    #: Bits of the table of neighbours, and the factor that spreads its entries.
    BITS, SPREAD = 22, 0x9E3779B1

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(a_path)
        if self.a.normalizer is not None or not isinstance(self.a.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError(f"{a_path} isn't a plain byte-level tokenizer")
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a_sizes = [0] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_sizes[i] = len(token)  # a character per byte
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_SIGN, " ").encode()
            for i, p in enumerate(pieces)
        ]
        spelt = [p.replace(SPACE_SIGN, " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        held = set("".join(spelt))
        # Put before a unit, this character keeps it apart from the space that B adds.
        self.apart = next(c for c in map(chr, range(10, 0x3000)) if c not in held and c not in " \r")
        self.head = len(self.b.encode(self.apart))
        self.neighbours = np.zeros(1 << self.BITS, bool)
        inner = "".join(p + "\0" for p in spelt)
        codes = np.frombuffer(inner.encode("utf-32-le"), np.uint32)
        inside = (codes[:-1] != 0) & (codes[1:] != 0)
        self.neighbours[self._slot(codes[:-1], codes[1:])[inside]] = True
        self.clear()

    def _slot(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of two characters in the table. Pairs that share one are taken for neighbours: fewer cuts, same groups."""
        mixed = (left.astype(np.uint64) << np.uint64(21) | right) * np.uint64(self.SPREAD)
        return (mixed >> np.uint64(11)) & np.uint64((1 << self.BITS) - 1)

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.kept = Results()

    def units(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(units of all texts in order, units per text). Every text gets its space first."""
        spaced = [" " + t for t in texts]
        lengths = np.fromiter(map(len, spaced), np.int64, len(spaced))
        joined = "".join(spaced)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(len(codes), bool)
        first[starts] = True
        places = np.flatnonzero(boundaries(codes, first) & ~first)
        symbols = class_table()[codes[places - 1]]
        places = places[(symbols != SPACE) & (symbols != BLANK)]
        seen = np.where(codes == ord(SPACE_SIGN), 0x20, codes)
        places = places[~self.neighbours[self._slot(seen[places - 1], seen[places])]]
        cuts = np.sort(np.concatenate([places, starts]))
        bounds = cuts.tolist() + [len(joined)]
        per_text = np.diff(np.append(np.searchsorted(cuts, starts), len(cuts)))
        return [joined[a:b] for a, b in zip(bounds, bounds[1:])], per_text

    def learn(self, units: list[str], into: Results) -> None:
        """Align units; one of which B doesn't keep the bytes gets -1 tokens."""
        a_lists = self.a.encode_batch_fast(units, add_special_tokens=False)
        b_lists = self.b.encode([self.apart + u for u in units], num_threads=1)
        a_sizes, b_bytes, head = self.a_sizes, self.b_bytes, self.head
        for unit, a_tokens, b_ids in zip(units, a_lists, b_lists):
            a_ids = a_tokens.ids
            b_ids = b_ids[head:]
            b_parts = [b_bytes[i] for i in b_ids]
            if b"".join(b_parts) != unit.encode("utf-8", "surrogatepass"):
                into.add([], (-1, -1, 0, 0))
                continue
            groups = groups_of(a_ids, [a_sizes[i] for i in a_ids], b_ids, list(map(len, b_parts)))
            links = sum([len(a) * len(b) for a, b in groups])
            into.add(groups, (len(a_ids), len(b_ids), len(groups), links))

    def lookup(self, units: list[str]) -> tuple[np.ndarray, Results]:
        """(place of every unit, results of units that the cache has no room for: their places come after the cache's)."""
        known = self.known
        new = [u for u in dict.fromkeys(units) if u not in known]
        if len(known) >= CACHE_UNITS and len(new) > STALE * len(units):
            self.clear()
            return self.lookup(units)
        room = CACHE_UNITS - len(known)
        stay = [u for u in new if len(u) <= CACHED_LENGTH][: max(0, room)]
        self.learn(stay, self.kept)
        for unit in stay:
            known[unit] = len(known)
        extra = Results()
        own = {u: len(known) + n for n, u in enumerate(u for u in new if u not in known)}
        if own:
            self.learn(list(own), extra)
        index = (known[u] if u in known else own[u] for u in units) if own else map(known.__getitem__, units)
        return np.fromiter(index, np.int64, len(units)), extra

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[np.ndarray]]:
        """Per text: (tokens of A, of B, groups, links), groups as text, distinct pairs, links of each pair."""
        full = np.array([bool(t) for t in texts])
        units, per_text = self.units([t for t in texts if t])
        index, extra = self.lookup(units)
        kept, base = self.kept, len(self.known)
        owner = np.repeat(np.flatnonzero(full), per_text)
        old = index < base
        # Sums of all units, those whose bytes are kept by both only.
        sums = np.empty((len(units), 4), np.int64)
        sums[old] = np.frombuffer(kept.sums, np.int64).reshape(-1, 4)[index[old]]
        if extra.texts:
            sums[~old] = np.frombuffer(extra.sums, np.int64).reshape(-1, 4)[index[~old] - base]
        lost = np.zeros(len(texts), bool)
        lost[owner[sums[:, 0] < 0]] = True
        totals = np.stack([np.bincount(owner, c, len(texts)) for c in sums.T], 1).astype(np.int64)
        totals[lost] = 0
        # Pairs of every distinct unit of a text, then of every text.
        size = base + len(extra.texts)
        met, counts = np.unique(owner * size + index, return_counts=True)
        parts = []
        for source, mine, shift in ((kept, met % size < base, 0), (extra, met % size >= base, base)):
            ends = np.frombuffer(source.ends, np.int64)
            unit = met[mine] % size - shift
            starts, sizes = ends[unit], ends[unit + 1] - ends[unit]
            text = np.repeat(met[mine] // size, sizes)
            pairs = ragged(np.frombuffer(source.pairs, np.int64), starts, sizes)
            times = ragged(np.frombuffer(source.times, np.int64), starts, sizes) * np.repeat(counts[mine], sizes)
            parts.append((text, pairs, times))
        text, pairs, times = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pairs, text))
        text, pairs, times = text[order], pairs[order], times[order]
        fresh = np.append(True, (text[1:] != text[:-1]) | (pairs[1:] != pairs[:-1]))[: len(text)]
        at = np.flatnonzero(fresh)
        text, pairs = text[at], pairs[at]
        times = np.add.reduceat(times, at) if len(at) else times
        splits = np.searchsorted(text, np.arange(1, len(texts)))
        words = kept.texts + extra.texts if extra.texts else kept.texts
        strings, lo = [], 0
        places = index.tolist()
        nothing = np.zeros(0, np.int64)
        per = iter(per_text.tolist())
        for n, has in enumerate(full.tolist()):
            size = next(per) if has else 0
            strings.append("" if lost[n] else ";".join([words[i] for i in places[lo : lo + size]]))
            lo += size
        keep = [not x for x in lost.tolist()]
        pair_lists = [p if k else nothing for p, k in zip(np.split(pairs, splits), keep)]
        time_lists = [t if k else nothing for t, k in zip(np.split(times, splits), keep)]
        return totals, strings, pair_lists, time_lists


@lru_cache(maxsize=2)
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """The worker's pair: later tasks of the same worker find its cache filled."""
    return Pair(a_path, b_path)


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- Operators --------------------------------------------------------------------------

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def align(
    df: DataFrame, a_path: str, b_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Aligns every text: the columns ``keep``, token, group and link counts, the groups, and the linked id pairs.

    ``groups`` is text (``a1,a2|b1;a3|b2,b3``); ``pairs`` holds each linked id pair once, as the A id times
    2^32 plus the B id, ascending, and ``times`` its links. Texts that are null or empty, or of which a
    tokenizer doesn't keep all bytes, have no tokens: zeros, an empty string and empty arrays. Every row is aligned
    by itself, so repeated rows and null keys need no care, and an empty table gives an empty one.
    Columns that aren't kept may have any name.
    """
    kept = [df.schema[c] for c in keep]
    names = [f"_k{i}" for i in range(len(kept))]
    source = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))
    fields = "".join(f"{n} {f.dataType.simpleString()}, " for n, f in zip(names, kept))
    out_names = [*names, *[f.split()[0] for f in ALIGNED.split(", ")]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizer_pair(a_path, b_path)
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column(batch.num_columns - 1)):
                rows = batch.slice(at, len(block))
                at += len(block)
                sums, texts, pairs, times = both.align(block)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, np.concatenate(x)) for x in (pairs, times)]
                numbers = [pa.array(np.ascontiguousarray(n)) for n in sums.T]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], *numbers, pa.array(texts, pa.string()), *lists], names=out_names
                )

    return source.transform(small_batches).mapInArrow(run, fields + ALIGNED).withColumnsRenamed(dict(zip(names, keep)))


def pair_counts(linked: DataFrame) -> DataFrame:
    """Per id pair of (row, pair, times): ``documents`` that hold it, and whether no pair of its A id is in more."""
    counts = materialize(linked.groupBy("pair").agg(F.count(F.lit(1)).alias("documents")))
    a_id = F.shiftright("pair", 32)
    # A row per A id: bounded by the vocabulary.
    best = counts.groupBy(a_id.alias("a_id")).agg(F.max("documents").alias("most"))
    joined = counts.withColumn("a_id", a_id).join(small(best), "a_id")
    return joined.select("pair", "documents", (F.col("documents") == F.col("most")).alias("is_best"))


def frequent(counts: DataFrame, limit: int) -> int:
    """The smallest number of documents that at most ``limit`` pairs reach, among the powers of the fourth root of 2.

    Only a histogram of these powers reaches the driver.
    """
    step = F.floor(4 * F.log2(F.col("documents").cast("double")) + 1e-9).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(step.alias("step")).count().collect()}
    total, least = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > limit:
            return least if least is not None else 1 << 62
        least = int(np.ceil(2 ** ((at - 1e-9) / 4)))
    return 0


def with_link_counts(aligned: DataFrame, row: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to a stored result of :func:`align`; ``row`` tells its rows apart.

    ``n_best``: links whose pair is in as many documents as any pair of its A id. ``count_sum``: documents
    of the pair, over all links. ``pairs`` and ``times`` go. Rows without links get zeros.
    """
    linked = aligned.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("e"))
    linked = linked.select(row, F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    counts = materialize(pair_counts(linked))
    least = frequent(counts, hot_pairs)
    hot = F.broadcast(counts.where(F.col("documents") >= least))

    def sums(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(row).agg(
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
        )

    parts = [sums(linked.join(hot, "pair"))]
    if least > 0:
        parts.append(sums(linked.join(hot, "pair", "left_anti").join(counts.where(F.col("documents") < least), "pair")))
    both = parts[0]
    if len(parts) > 1:
        both = both.unionByName(parts[1]).groupBy(row).agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return aligned.drop("pairs", "times").join(both, row, "left").fillna(0, ["n_best", "count_sum"])


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned; the aligned rows are stored once for the counts over the corpus."""
    rows = align(read(spark, sf_dir, "documents"), library_path(), piece_path())
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    folder = new_folder(spark, "alignment")
    (
        rows.withColumns({"groups_sha256": digest, "_row": F.monotonically_increasing_id()})
        .drop("groups")
        .write.option("compression", "zstd")
        .parquet(folder)
    )
    counted = with_link_counts(spark.read.parquet(folder), "_row")
    return counted.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
