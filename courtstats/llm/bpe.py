"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points become classes (letter, number, space, other white space, apostrophe that may start a
contraction, anything else); a class is a transition function on the states of a small
automaton. Functions compose associatively, so the state before every code point comes from a
blocked prefix scan over composition tables: no regular expression, no loop over characters.
A code point starts a piece where its class, its state and its right neighbour say so.

Distinct pieces are merged once per worker and cached (up to a bound); the pieces' byte
offsets are kept with the ids, so decoding can be checked piece by piece.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, filterfalse

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, read, small_batches
from .wordscan import BASE, INVERSE, mix, powers

# --- Automaton --------------------------------------------------------------------------

# Symbols. A1 and A2 are apostrophes followed by a contraction of one or two letters.
LETTER, NUMBER, OTHER, SPACE, BLANK, A1, A2 = range(7)
# States: text start, after a letter, number, other, space, blank; one or two
# letters of a contraction still to come; contraction just ended.
START, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_BLANK, ONE_LEFT, TWO_LEFT, ENDED = range(9)
STATES, SYMBOLS = 9, 7

#: Contractions of the pattern by length (fixed values).
SHORT, LONG = "stmd", ("re", "ve", "ll")


def _step(state: int, symbol: int) -> int:
    if symbol == LETTER:
        return {TWO_LEFT: ONE_LEFT, ONE_LEFT: ENDED}.get(state, S_LETTER)
    if symbol in (A1, A2):
        # Behind a space or another symbol the apostrophe belongs to a run of symbols.
        if state in (S_SPACE, S_OTHER):
            return S_OTHER
        return ONE_LEFT if symbol == A1 else TWO_LEFT
    return {NUMBER: S_NUMBER, OTHER: S_OTHER, SPACE: S_SPACE, BLANK: S_BLANK}[symbol]


def _starts(state: int, symbol: int) -> bool:
    """Whether a symbol in this state starts a piece, if it is not white space."""
    if state in (START, S_BLANK, ENDED):
        return True
    if state in (S_SPACE, ONE_LEFT, TWO_LEFT):
        return False
    same = {S_LETTER: (LETTER,), S_NUMBER: (NUMBER,), S_OTHER: (OTHER, A1, A2)}[state]
    return symbol not in same


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that symbols and text starts compose to: (their tables, products, generators).

    Generator ``symbol`` is the symbol's function; ``SYMBOLS + symbol`` first goes back to the start.
    """
    plain = [tuple(_step(s, c) for s in range(STATES)) for c in range(SYMBOLS)]
    first = [(f[START],) * STATES for f in plain]
    found = list(dict.fromkeys(plain + first))
    index = {f: i for i, f in enumerate(found)}
    for f in found:  # grows while it is read
        for g in plain + first:
            for h in (tuple(g[s] for s in f),):
                if h not in index:
                    index[h] = len(found)
                    found.append(h)
    table = np.array(found, np.uint8)
    product = np.array(
        [[index[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8
    )
    gens = np.array([index[f] for f in plain + first], np.uint8)
    return table, product.ravel(), gens


TABLE, PRODUCT, GENERATORS = _monoid()
_WIDTH = len(TABLE)
START_RULE = np.array([[_starts(s, c) for c in range(SYMBOLS)] for s in range(STATES)]).ravel()


def scan(functions: np.ndarray, block: int = 64) -> np.ndarray:
    """Inclusive prefix products of transition functions, by blocks.

    All blocks advance together, one column at a time; the block products are scanned the same way
    and multiplied onto the blocks after them.
    """
    n = len(functions)
    if n <= block:
        out = functions.copy()
        for i in range(1, n):
            out[i] = PRODUCT[int(out[i - 1]) * _WIDTH + int(out[i])]
        return out
    rows = -(-n // block)
    padded = np.zeros(rows * block, np.uint8)
    padded[:n] = functions
    grid = np.ascontiguousarray(padded.reshape(rows, block).T)
    for i in range(1, block):
        grid[i] = PRODUCT[grid[i - 1].astype(np.intp) * _WIDTH + grid[i]]
    if rows > 1:
        carried = scan(grid[-1][:-1], block)
        grid[:, 1:] = PRODUCT[carried.astype(np.intp)[None, :] * _WIDTH + grid[:, 1:]]
    return np.ascontiguousarray(grid.T).ravel()[:n]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Symbol of every code point, from the Unicode properties that the pattern names.

    Unicode versions differ in which code points are letters, so the properties are read from the
    tables of the library whose pieces must be equalled: a vocabulary of single bytes with the property
    as its pattern returns the bytes of just the code points that have it.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for found, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        having = tiktoken.Encoding("property", pat_str=found, mergeable_ranks=single, special_tokens={})
        out[[ord(c) for c in bytes(having.encode_ordinary(every)).decode()]] = symbol
    out[0x20] = SPACE
    return out


def boundaries(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points start a piece. ``first`` marks the first code point of every text."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, bool)
    symbols = class_table()[codes]
    # A text's last code point has no neighbour to its right.
    last = np.append(first[1:], True)
    quotes = np.flatnonzero((codes == 0x27) & ~last)
    if len(quotes):
        following = np.append(codes, 0)
        one, two = codes[quotes + 1], np.where(last[quotes + 1], 0, following[quotes + 2])
        for letter in SHORT:
            symbols[quotes[one == ord(letter)]] = A1
        for a, b in LONG:
            symbols[quotes[(one == ord(a)) & (two == ord(b))]] = A2
    prefix = scan(GENERATORS[symbols + SYMBOLS * first.astype(np.uint8)])
    after = TABLE[prefix, START]  # every text's prefix has forgotten the state before it
    before = np.empty(n, np.uint8)
    before[0] = START
    before[1:] = after[:-1]
    before[first] = START
    blank = (symbols == SPACE) | (symbols == BLANK)
    run_start = ~((before == S_SPACE) | (before == S_BLANK))
    ends_run = np.append(~blank[1:], False) & ~last
    return np.where(blank, run_start | ends_run, START_RULE[before.astype(np.intp) * SYMBOLS + symbols])


# --- Merging ----------------------------------------------------------------------------


#: Bytes up to which a piece is merged by a plain list of pairs.
SHORT_PIECE = 48
NO_PAIR = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a line holds a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of lowest rank, leftmost among equals, is merged until none is left.

    Short pieces take a list of pair ranks; longer ones a heap over linked parts, which is n log n.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= SHORT_PIECE:
        parts = [piece[i : i + 1] for i in range(n)]
        pairs = [ranks.get(piece[i : i + 2], NO_PAIR) for i in range(n - 1)]
        while pairs and (best := min(pairs)) < NO_PAIR:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_PAIR)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_PAIR)
        return [ranks[p] for p in parts]
    end = list(range(1, n + 1))  # end[i] = end of the part that starts at i; 0: merged away
    left = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue  # one of its parts has been merged since
        end[i], end[mid] = stop, 0
        if stop < n:
            left[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        j = left[i]
        if j >= 0:
            rank = ranks.get(piece[j:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


#: Bytes of a block up to which its pieces are found by hashes; hashing takes 24 bytes of memory a byte.
SPAN_BYTES = 1 << 22


class PieceCache:
    """Ids of the pieces met so far, as one flat array with offsets; emptied at ``limit`` pieces.

    The pieces of a block are looked up together: a 64-bit hash per piece leads to its place in an open table, and the
    spellings kept there, one after the other, must give the block's bytes again. Only pieces that are
    new become objects of their own.
    """

    def __init__(self, encode_pieces, limit: int = 150_000):
        self.encode_pieces, self.limit = encode_pieces, limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = array("I")
        self.offsets = array("q", [0])
        self.spelt, self.spelt_at = bytearray(), array("q", [0])
        size = 1 << (2 * self.limit + 1024).bit_length()
        self.slots, self.places = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def _add(self, pieces: list[bytes]) -> int:
        """Keep the ids and spellings of new pieces; returns the place of the first."""
        base = len(self.offsets) - 1
        for piece, ids in zip(pieces, self.encode_pieces(pieces)):
            self.flat.extend(ids)
            self.offsets.append(len(self.flat))
            self.spelt += piece
            self.spelt_at.append(len(self.spelt))
        return base

    def _ids(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Views, given up on return: a lookup costs what its pieces cost, not what the cache holds.
        offsets, flat = np.frombuffer(self.offsets, np.int64), np.frombuffer(self.flat, np.uint32)
        starts = offsets[index]
        counts = offsets[index + 1] - starts
        return ragged(flat, starts, counts), counts

    def lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the pieces one after the other, ids per piece)."""
        if len(self.offsets) > self.limit:
            self.clear()
        known = self.known
        new = list(dict.fromkeys(filterfalse(known.__contains__, pieces)))
        known.update(zip(new, count(self._add(new))))
        return self._ids(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces)))

    def lookup_spans(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:func:`lookup` of the pieces ``data[start:end]``, which follow each other and make up all of ``data``."""
        if len(data) <= SPAN_BYTES:
            if len(self.offsets) > self.limit:
                self.clear()
            hashes = span_hashes(data, starts, ends)
            index = self._find(hashes)
            missing = np.flatnonzero(index < 0)
            if len(missing):
                fresh, first = np.unique(hashes[missing], return_index=True)
                at = missing[first]
                base = self._add([data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
                self._insert(fresh, base)
                index[missing] = base + np.searchsorted(fresh, hashes[missing])
            spelt_at = np.frombuffer(self.spelt_at, np.int64)
            again = ragged(np.frombuffer(self.spelt, np.uint8), spelt_at[index], spelt_at[index + 1] - spelt_at[index])
            if np.array_equal(again, np.frombuffer(data, np.uint8)):
                return self._ids(index)
            del spelt_at  # two pieces share a hash: a view would keep the arrays from growing
        return self.lookup([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of every hash, or -1."""
        last = np.uint64(len(self.slots) - 1)
        out = np.full(len(hashes), -1, np.int64)
        at, open_ = hashes & last, np.arange(len(hashes))
        while len(open_):
            held = self.slots[at]
            hit = held == hashes[open_]
            out[open_[hit]] = self.places[at[hit]]
            further = ~hit & (held != 0)
            open_, at = open_[further], (at[further] + np.uint64(1)) & last
        return out

    def _insert(self, fresh: np.ndarray, base: int) -> None:
        """Give distinct new hashes the places from ``base`` on. The table is never more than half full."""
        while 2 * (len(self.offsets) + len(fresh)) > len(self.slots):
            self._grow()
        self._place(fresh, np.arange(base, base + len(fresh), dtype=np.int32))

    def _place(self, hashes: np.ndarray, places: np.ndarray) -> None:
        last = np.uint64(len(self.slots) - 1)
        at = hashes & last
        while len(hashes):
            free = self.slots[at] == 0
            self.slots[at[free]] = hashes[free]
            won = free & (self.slots[at] == hashes)
            self.places[at[won]] = places[won]
            hashes, places, at = hashes[~won], places[~won], (at[~won] + np.uint64(1)) & last

    def _grow(self) -> None:
        held = self.slots != 0
        hashes, places = self.slots[held], self.places[held]
        self.slots, self.places = np.zeros(2 * len(self.slots), np.uint64), np.zeros(2 * len(self.slots), np.int32)
        self._place(hashes, places)


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every range of the bytes, never 0."""
    raw = np.frombuffer(data, np.uint8)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
    inner = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mix(inner + (ends - starts).astype(np.uint64)) | np.uint64(1)


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices ``flat[starts : starts + counts]`` one after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


def text_blocks(texts: Iterable, size: int = 1 << 19) -> Iterator[list[str]]:
    """Consecutive runs of texts of about ``size`` code points; a longer text is a run of its own.

    Texts may be strings or an Arrow column, of which only a run at a time becomes strings; null is empty.
    """
    run, total = [], 0
    for text in texts:
        text = text if isinstance(text, str) else (text.as_py() if text is not None else None) or ""
        if run and total + len(text) > size:
            yield run
            run, total = [], 0
        run.append(text)
        total += len(text)
    if run:
        yield run


def encode_block(texts: list[str], cache: PieceCache) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its ids, and the end of each piece as (byte offset, number of ids so far)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    text_end = np.cumsum(lengths)
    text_start = text_end - lengths
    first = np.zeros(len(codes), bool)
    first[text_start[lengths > 0]] = True
    cuts = np.flatnonzero(boundaries(codes, first))
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    byte_at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    starts = byte_at[cuts]
    ends = np.append(starts[1:], byte_at[-1])
    data = joined.encode("utf-8", "surrogatepass")
    ids, counts = cache.lookup_spans(data, starts, ends)
    id_end = np.cumsum(counts)
    piece_lo = np.searchsorted(cuts, text_start)
    piece_hi = np.searchsorted(cuts, text_end)
    for t in range(len(texts)):
        lo, hi = piece_lo[t], piece_hi[t]
        if lo == hi:
            yield ids[:0], np.zeros((0, 2), np.int64)
            continue
        base = id_end[lo] - counts[lo]
        offsets = np.stack([ends[lo:hi] - byte_at[text_start[t]], id_end[lo:hi] - base], 1)
        yield ids[base : id_end[hi - 1]], offsets


_CACHES: dict[str, PieceCache] = {}


def _cache(path: str) -> PieceCache:
    """The worker's cache for a vocabulary: later tasks of the same worker find it filled."""
    if path not in _CACHES:
        ranks = load_ranks(path)
        _CACHES[path] = PieceCache(lambda pieces: (merge(p, ranks) for p in pieces))
    return _CACHES[path]


# --- Operators --------------------------------------------------------------------------


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """Ids of every text: the columns ``keep``, ids and pieces.

    ``ids`` is binary, the ids as little-endian unsigned 32-bit integers; ``pieces`` is binary, two
    such integers per piece: its end in the text's UTF-8 bytes and the number of ids so far.
    ``path`` names the rank file; it must be readable on every executor. Null and empty texts
    have no ids. Row order and repeated rows don't matter: a row is encoded by itself.
    """
    kept = [df.schema[c] for c in keep]
    names = [f"_k{i}" for i in range(len(kept))]
    source = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))
    fields = "".join(f"{n} {f.dataType.simpleString()}, " for n, f in zip(names, kept))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path)
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column(batch.num_columns - 1)):
                rows = batch.slice(at, len(block))
                at += len(block)
                ids, pieces = [], []
                for i, o in encode_block(block, cache):
                    ids.append(i.astype("<u4").tobytes())
                    pieces.append(o.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.array(ids, pa.binary()), pa.array(pieces, pa.binary())],
                    names=[*names, "ids", "pieces"],
                )

    made = source.transform(small_batches).mapInArrow(run, f"{fields}ids binary, pieces binary")
    return made.withColumnsRenamed(dict(zip(names, keep)))


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the bytes of every row's binary ids. Null and empty ids give no bytes.

    Where the row has ``pieces``, every piece of the result must end at its kept offset; a row of which
    this isn't true raises, as its ids belong to another text or vocabulary.
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    at = df.columns.index(ids)
    offsets = df.columns.index("pieces") if "pieces" in df.columns else None
    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, df.schema.fields))
    renamed = df.toDF(*names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        token = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            token[rank] = piece
        sizes = np.fromiter(map(len, token), np.int64, len(token))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                out = []
                for i, raw in enumerate(rows.column(at)):
                    found = np.frombuffer(raw.as_py() or b"", "<u4")
                    out.append(b"".join(map(token.__getitem__, found.tolist())))
                    if offsets is not None and len(found):
                        kept = np.frombuffer(rows.column(offsets)[i].as_py(), "<u4").reshape(-1, 2)
                        ends = np.cumsum(sizes[found])
                        if kept[-1, 1] != len(found) or (ends[kept[:, 1] - 1] != kept[:, 0]).any():
                            raise ValueError("ids don't end at the kept offsets")
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(out, pa.binary())], names=[*names, "decoded"]
                )

    made = renamed.transform(small_batches).mapInArrow(run, f"{fields}, decoded binary")
    return made.toDF(*df.columns, "decoded")


def multi_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again."""
    path = multi_path()
    coded = decode(encode(read(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
