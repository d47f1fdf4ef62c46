"""Line dedup by content-defined chunks of lines.

Every run of lines that holds ``MIN_WORDS`` words, and no fewer lines than it needs for them, has a boundary: the place
where the rolling hash of two consecutive lines is least within the run. It depends on nothing outside the run, so it
doesn't shift with text inserted earlier, and equal runs have equal boundaries. Neighbouring runs mostly share theirs; the lines
around a boundary that its runs span are one chunk. A repeated passage of so many words consists of such runs (one
starts at each line of it that has the words ahead, one ends at each that has them behind), so it holds
a boundary, wherever it lies in its host.

Boundaries are counted over the whole corpus by their hash. Chunks whose boundary occurs once go. The others are
widened line by line to their runs, which are counted by boundary and hash. Runs that follow one another in a text and have their first
occurrences follow one another too are joined to a maximal stretch, and each stretch is compared byte by byte with its
first occurrence: a line is sent once a stretch, not once a run. The first occurrence (by document id, then line)
stays, lines of later ones are marked, also if they overlap the first, and marked lines are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import query, read, small, small_batches
from .wordscan import BASE, Scan, mix, scans

#: Words of a run of repeated lines from which it is removed.
MIN_WORDS = 50
#: Lines of a first occurrence up to which a stretch is compared in one piece.
PIECE_LINES = 256


def line_windows(total: np.ndarray, line_at: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line: end of the shortest window of ``min_words`` words that starts there, start of that which ends there.

    ``total``: words before every line and behind the last; ``line_at``: first line of every text and
    the end. A window that would leave its text is -1.
    """
    least, sizes = max(1, min_words), np.diff(line_at)
    ends = np.searchsorted(total, total[:-1] + least, "left")
    starts = np.searchsorted(total, total[1:] - least, "right") - 1
    ends[ends > np.repeat(line_at[1:], sizes)] = -1
    starts[starts < np.repeat(line_at[:-1], sizes)] = -1
    return ends, starts


def line_runs(scan: Scan, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and end lines of the shortest runs of ``min_words`` words of all texts, by first line."""
    words = np.searchsorted(scan.word_start, scan.line_end) - np.searchsorted(scan.word_start, scan.line_start)
    ends, starts = line_windows(np.concatenate([[0], np.cumsum(words)]), scan.line_at, min_words)
    ahead, back = np.flatnonzero(ends >= 0), np.flatnonzero(starts >= 0)
    lo = np.concatenate([ahead, starts[back]])
    hi = np.concatenate([ends[ahead], back + 1])
    n = len(words) + 1
    return np.divmod(np.unique(lo * n + hi), n)


def first_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the least value in every range [lo, hi), the first of equal ones."""
    found = np.zeros(len(lo), np.int64)
    levels = np.frexp((hi - lo).astype(np.float64))[1] - 1  # of the largest power of two that fits
    least = np.arange(len(values))  # place of the least of the next 2**level values
    for level in range(int(levels.max(initial=-1)) + 1):
        at = np.flatnonzero(levels == level)
        left, right = least[lo[at]], least[hi[at] - (1 << level)]
        found[at] = np.where(values[right] < values[left], right, left)
        left, right = least[: -(1 << level)], least[1 << level :]
        least = np.where(values[right] < values[left], right, left)
    return found


def boundaries(line_hash: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the boundary of every run of lines; a run of one line is its own."""
    rolled = mix(line_hash[:-1] * np.uint64(BASE) + line_hash[1:])
    place, found = lo.copy(), line_hash[lo]
    several = np.flatnonzero(hi - lo > 1)
    place[several] = first_least(rolled, lo[several], hi[several] - 1)
    found[several] = rolled[place[several]]
    return place, found


def text_spans(
    scan: Scan, bits: int = 64, min_words: int = MIN_WORDS
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first lines, end lines, hashes) of the runs of every text, each once."""
    lo, hi = line_runs(scan, min_words)
    hashes = scan.hashes(scan.line_start[lo], scan.line_end[hi - 1]) >> np.uint64(64 - bits)
    cuts = np.searchsorted(lo, scan.line_at)
    for text, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if a < b:
            yield text, lo[a:b] - scan.line_at[text], hi[a:b] - scan.line_at[text], hashes[a:b]


def chunks(df: DataFrame, bits: int = 64, chunk_bits: int = 64, min_words: int = MIN_WORDS) -> DataFrame:
    """(chunk, key, version, runs) of rows (key, version, text): every boundary's hash and runs (lo, hi, hash)."""
    kind = df.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, scan in scans(batch.column("text")):
                rows = batch.slice(at, n)
                at += n
                spans = list(text_spans(scan, bits, min_words))
                if not spans:
                    continue
                owner = np.repeat([s[0] for s in spans], [len(s[1]) for s in spans])
                lo, hi, hashes = (np.concatenate([s[k] for s in spans]) for k in (1, 2, 3))
                start = scan.line_at[owner]
                line_hash = scan.hashes(scan.line_start, scan.line_end)
                place, found = boundaries(line_hash, lo + start, hi + start)
                # Runs of one boundary side by side; a line that is a run of its own is another chunk.
                chunk = place * 2 + (hi - lo == 1)
                order = np.argsort(chunk, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(chunk[order]) != 0]))
                held = pa.StructArray.from_arrays(
                    [
                        pa.array(lo[order].astype(np.int32)),
                        pa.array(hi[order].astype(np.int32)),
                        pa.array(hashes[order].view(np.int64)),
                    ],
                    names=["lo", "hi", "hash"],
                )
                whose = pa.array(owner[order[first]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((found[order[first]] >> np.uint64(64 - chunk_bits)).view(np.int64)),
                        rows.column("key").take(whose),
                        rows.column("version").take(whose),
                        pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), held),
                    ],
                    names=["chunk", "key", "version", "runs"],
                )

    runs = "array<struct<lo: int, hi: int, hash: long>>"
    return df.transform(small_batches).mapInArrow(run, f"chunk long, key {kind}, version long, runs {runs}")


def candidates(found: DataFrame) -> DataFrame:
    """(key, version, chunk, lo, hi, hash): the runs of chunks whose boundary occurs at several places."""
    repeated = materialize(found.groupBy("chunk").agg(F.count("*").alias("_n")).where("_n > 1").select("chunk"))
    return found.join(repeated, "chunk").select("key", "version", "chunk", F.inline("runs"))


def packed(df: DataFrame) -> DataFrame:
    """The same rows with ``text`` compressed: texts cross two shuffles, which is most of the disk used."""
    at = df.columns.index("text")
    kinds = ["binary" if f.name == "text" else f.dataType.simpleString() for f in df.schema.fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = (v.as_py() for v in batch.column(at))
            small = [None if t is None else compress(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield batch.set_column(at, "text", pa.array(small, pa.binary()))

    fields = ", ".join(f"{n} {k}" for n, k in zip(df.columns, kinds))
    return df.transform(small_batches).mapInArrow(run, fields)


def unpacked(value: bytes | None) -> str | None:
    if value is None:
        return None
    return zstandard.ZstdDecompressor().decompress(value).decode("utf-8", "surrogatepass")


def _bodies(df: DataFrame, names: list[str]) -> DataFrame:
    """(key, version, the fields ``names`` of a mark, body): the lines of every listed mark of every text.

    What is equal in all columns but key and version, and follows shortly, is stated once if ``key`` is no column of
    the result: copies of one text then leave a batch as one row.
    """
    kinds = {f.name: f.dataType for f in df.schema["spans"].dataType.elementType.fields}
    whose = "key" not in names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 32) for b in batches for at in range(0, b.num_rows, 32)):
            met: set[tuple] = set()
            marks = batch.column("spans")
            flat, starts = marks.flatten(), np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy())])
            fields = dict(zip(kinds, flat.flatten()))
            lo, hi = fields["lo"].to_pylist(), fields["hi"].to_pylist()
            told = list(zip(*[fields[n].to_pylist() for n in names]))
            owner, taken, bodies, size = [], [], [], 0

            def block() -> pa.RecordBatch:
                at = pa.array(taken, pa.int64())
                kept = [batch.column(c).take(pa.array(owner, pa.int64())) for c in ("key", "version")] if whose else []
                return pa.RecordBatch.from_arrays(
                    [*kept, *[fields[n].take(at) for n in names], pa.array(bodies, pa.binary())],
                    names=[*(["key", "version"] if whose else []), *names, "body"],
                )

            for row in range(batch.num_rows):
                lines = unpacked(batch.column("text")[row].as_py()).encode("utf-8", "surrogatepass").split(b"\n")
                for i in range(starts[row], starts[row + 1]):
                    body = b"\n".join(lines[lo[i] : hi[i]])
                    if not whose and (told[i], body) in met:
                        continue
                    met.add((told[i], body))
                    owner.append(row)
                    taken.append(i)
                    bodies.append(body)
                    size += len(body)
                    if size > 1 << 21:
                        yield block()
                        owner, taken, bodies, size = [], [], [], 0
                        met.clear()
            yield block()

    said = ", ".join(f"{n} {kinds[n].simpleString()}" for n in names)
    key = f"key {df.schema['key'].dataType.simpleString()}, version long, " if whose else ""
    return df.transform(small_batches).mapInArrow(run, f"{key}{said}, body binary")


def _later(found: DataFrame, by: list[str]) -> DataFrame:
    """Occurrences that aren't the first by equal ``by``, with the first's place in k, v and at."""
    # Stored, so that both sides of the join are shuffles and a frequent run's rows can be split over tasks.
    groups = materialize(
        found.groupBy(*by)
        .agg(F.count("*").alias("_n"), F.min(F.struct("key", "version", "lo")).alias("_first"))
        .where("_n > 1")
        .select(*by, F.col("_first.key").alias("k"), F.col("_first.version").alias("v"), F.col("_first.lo").alias("at"))
    )
    first = F.col("key").eqNullSafe(F.col("k")) & (F.col("version") == F.col("v")) & (F.col("lo") == F.col("at"))
    return found.join(groups, by).where(~first)


def stretches(later: DataFrame) -> DataFrame:
    """(key, version, lo, hi, k, v, at): maximal stretches of runs that touch and lie equally far from their first occurrences.

    Cut where the lines of the first occurrence pass a multiple of ``PIECE_LINES``, so that a text many others
    repeat parts of is asked for a bounded number of different pieces.
    """
    line = ["key", "version", "k", "v", "shift"]
    along = Window.partitionBy(*line).orderBy("lo", "hi")
    opens = F.col("lo") > F.coalesce(
        F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)
    )
    joined = (
        later.select("key", "version", "k", "v", (F.col("lo") - F.col("at")).alias("shift"), "lo", "hi")
        .withColumn("opens", opens.cast("long"))
        .withColumn("nr", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*line, "nr")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    pieces = joined.select(
        *line, "lo", "hi", F.explode(_pieces(F.col("lo") - F.col("shift"), F.col("hi") - F.col("shift"))).alias("piece")
    )
    start = F.greatest(F.col("lo"), F.col("piece") * PIECE_LINES + F.col("shift"))
    end = F.least(F.col("hi"), (F.col("piece") + 1) * PIECE_LINES + F.col("shift"))
    return pieces.select(
        "key", "version", start.cast("int").alias("lo"), end.cast("int").alias("hi"), "k", "v",
        (start - F.col("shift")).cast("int").alias("at"),
    )


def _pieces(lo: Column, hi: Column) -> Column:
    """Numbers of the pieces that hold lines of [lo, hi)."""
    return F.sequence(F.floor(lo / PIECE_LINES), F.floor((hi - 1) / PIECE_LINES))


def evidence(docs: DataFrame, later: DataFrame) -> DataFrame:
    """(k, v, at, n, body): the bytes of every stretch, of the first and of the later occurrences."""
    said = stretches(later).withColumn("n", F.col("hi") - F.col("lo"))
    one = said.select("k", "v", "at", "n").distinct()
    firsts = one.select(
        F.col("k").alias("key"), F.col("v").alias("version"),
        F.col("at").alias("lo"), (F.col("at") + F.col("n")).alias("hi"), "k", "v", "at", "n",
    )
    listed = _per_text(packed(docs), said.unionByName(firsts), "inner")
    return _bodies(listed, ["k", "v", "at", "n"])


def _per_text(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with the list of the marks (structs) on their text."""
    listed = marks.groupBy(F.col("key").alias("_key"), F.col("version").alias("_version")).agg(
        F.collect_set(F.struct(*[c for c in marks.columns if c not in ("key", "version")])).alias("spans")
    )
    same = docs["key"].eqNullSafe(F.col("_key")) & (docs["version"] == F.col("_version"))
    return docs.join(listed, same, how).select(docs["*"], "spans")


def repeated_spans(
    docs: DataFrame, bits: int = 64, chunk_bits: int = 64, min_words: int = MIN_WORDS
) -> DataFrame:
    """(key, version, lo, hi) of all later occurrences of runs that are equal byte by byte."""
    columns = ["key", "version", "lo", "hi"]
    found = materialize(candidates(materialize(chunks(docs, bits, chunk_bits, min_words))))
    later = materialize(_later(found, ["chunk", "hash"]))
    # All bytes of a stretch are the same everywhere if the smallest and the largest are.
    unequal = small(
        evidence(docs, later)
        .groupBy("k", "v", "at", "n")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .where("low <> high")
        .select(F.col("k").alias("_k"), F.col("v").alias("_v"), F.floor(F.col("at") / PIECE_LINES).alias("_piece"))
        .distinct()
    )
    if not unequal.take(1):
        return later.select(*columns)
    # Hashes that may stand for several texts: their runs are grouped anew by the texts themselves.
    length = F.col("hi") - F.col("lo")
    by_piece = later.select("chunk", "hash", "k", "v", F.explode(_pieces(F.col("at"), F.col("at") + length)).alias("piece"))
    same = F.col("k").eqNullSafe(F.col("_k")) & (F.col("v") == F.col("_v")) & (F.col("piece") == F.col("_piece"))
    wrong = materialize(by_piece.join(unequal, same, "left_semi").select("chunk", "hash").distinct())
    listed = _per_text(packed(docs), found.join(wrong, ["chunk", "hash"], "left_semi"), "inner")
    exact = _later(_bodies(listed, ["chunk", "hash", "lo", "hi"]), ["chunk", "hash", "body"])
    return later.join(wrong, ["chunk", "hash"], "left_anti").select(*columns).union(exact.select(*columns))


def _cut(df: DataFrame, min_words: int, names: list[str], kinds: list[str]) -> DataFrame:
    """Removes the marked runs from ``text``; the columns ``names`` pass through."""

    def cut(text: str, marks: list[dict]) -> tuple[str, int, int]:
        lines = text.split("\n")
        marked = np.zeros(len(lines) + 1, np.int64)
        for span in marks:
            marked[span["lo"]] += 1
            marked[span["hi"]] -= 1
        gone = (np.cumsum(marked)[:-1] > 0).tolist()
        kept, removed, removed_words, i = [], 0, 0, 0
        while i < len(lines):
            j = i
            while j < len(lines) and gone[j] == gone[i]:
                j += 1
            held = sum(len(line.encode("utf-8", "surrogatepass").split()) for line in lines[i:j]) if gone[i] else 0
            if gone[i] and held >= min_words:
                removed += j - i
                removed_words += held
            else:
                kept += lines[i:j]
            i = j
        return "\n".join(kept), removed, removed_words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 64) for b in batches for at in range(0, b.num_rows, 64)):
            texts = list(map(unpacked, batch.column("text").to_pylist()))
            marks = batch.column("spans").to_pylist()
            done = [cut(t, m) if t and m else (t, 0, 0) for t, m in zip(texts, marks)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array([d[0] for d in done], pa.string()),
                    pa.array([d[1] for d in done], pa.int64()),
                    pa.array([d[2] for d in done], pa.int64()),
                ],
                names=[*names, "text", "removed_lines", "removed_words"],
            )

    fields = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return df.select(*names, "text", "spans").transform(small_batches).mapInArrow(
        run, f"{fields}, text string, removed_lines long, removed_words long"
    )


def dedup_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] = (),
    min_words: int = MIN_WORDS,
    hash_bits: int = 64,
    line_hash_bits: int = 64,
) -> DataFrame:
    """All rows, with later occurrences of repeated runs of lines cut out of the text.

    Returns key, the columns ``keep``, text, removed_lines, removed_words. Lines are cut at line feeds. Null
    texts stay null and empty ones empty; a text all of whose lines repeat becomes empty, its row stays. Rows
    with the same key and text count as one document and get equal results. A null key comes first in
    the order. Whichever other columns there are, only those in ``keep`` are returned.
    """
    passed = [key, *keep]
    names = [f"_c{i}" for i in range(len(passed))]
    kinds = [df.schema[c].dataType.simpleString() for c in passed]
    docs = df.select(
        *[F.col(c).alias(n) for c, n in zip(passed, names)],
        F.col(key).alias("key"),
        F.xxhash64(text).alias("version"),
        F.col(text).alias("text"),
    )
    lean = docs.where(F.length("text") > 0).select("key", "version", "text")
    marked = _per_text(packed(docs), repeated_spans(lean, hash_bits, line_hash_bits, min_words), "left")
    made = _cut(marked, min_words, names, kinds)
    return made.select(
        *[F.col(n).alias(c) for c, n in zip(passed, names)],
        F.col("text").alias(text),
        "removed_lines",
        "removed_words",
    )


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated passages of lines: what was removed, and the text left."""
    made = dedup_lines(read(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "removed_lines",
        "removed_words",
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
        "text",
    )
