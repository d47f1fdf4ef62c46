"""Benchmark decontamination by size-partitioned MinHash containment search (built-in functions only).

An item (a short test text) is found in a document if the share of its distinct word
shingles that the document holds reaches a threshold. A fixed number of minima per document
would miss a short item in a long text, so both sides are sketched by size:

* Items are partitioned by their number of shingles, in powers of two. An item with q
  shingles keeps its k = q - ceil(t q) + 1 smallest shingle hashes. A document that holds t of its
  shingles can lack at most k - 1 of them, so it holds at least one of these k minima.
* For each size partition, the largest minimum is a bound. A document's sketch for the partition
  is all its shingle hashes up to that bound: it grows with the document, and no minimum of an
  item in the partition that the document holds can be missing. Documents with fewer shingles than the
  smallest item of the partition needs are skipped.
* The bounds grow with the number of items, up to all hashes. So the scan also looks each hash up in a bit
  set of all minima (two bits each), which is sent to every task and has a fixed largest size: it lets all minima
  pass and, until it reaches that size, about one in 4,000 of the other hashes.

Sketches meet in a join on the hash; each pair found is then verified on the shingles themselves.
So no pair is lost and none is wrong, at any length of the document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import BROADCAST_ROWS, WORD_BREAK, let, query, read, small

SHINGLE = 5
THRESHOLD = 0.8
#: Bits of the set of minima for each of them, and its largest size in bits (2 MB).
BITS_PER_MINIMUM = 128
MOST_BITS = 1 << 24
#: Characters of all shingles of the items up to which the items are sent to every task.
BROADCAST_CHARS = 64 << 20


def words(text: Column) -> Column:
    """Lower-cased words of a text; null or blank: an empty array."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_BREAK))
    return F.filter(parts, lambda w: w != "")


def shingles(tokens: Column, size: int) -> Column:
    """Word shingles, repeats included; fewer words than ``size``: none."""
    return let(
        tokens,
        lambda ws: F.transform(
            _starts(ws, size), lambda i: F.array_join(F.slice(ws, i, F.lit(size)), " ")
        ),
    )


def _starts(tokens: Column, size: int) -> Column:
    count = F.size(tokens) - (size - 1)
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(tokens: Column, size: int) -> Column:
    """Hashes of the shingles, from the hashes of their words: each word is hashed once."""
    return let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda hs: F.transform(
            _starts(hs, size), lambda i: F.xxhash64(F.slice(hs, i, F.lit(size)))
        ),
    )


def _items(benchmark: DataFrame, item: str, text: str, threshold: float) -> DataFrame:
    """Items with words: id, width of their shingles, the distinct shingles, size partition, needed count.

    An item of fewer than five words is one shingle as wide as itself.
    """
    cut = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("tokens")).where(
        F.size("tokens") > 0
    )
    wide = cut.withColumn("width", F.least(F.size("tokens"), F.lit(SHINGLE)))
    by_width = F.coalesce(
        *[F.when(F.col("width") == w, shingles(F.col("tokens"), w)) for w in range(1, SHINGLE + 1)]
    )
    kept = wide.select("item", "width", F.array_distinct(by_width).alias("shingles")).distinct()
    q = F.size("shingles")
    return kept.select(
        "item",
        "width",
        "shingles",
        F.floor(F.log2(q.cast("double"))).cast("int").alias("part"),
        # The small offset keeps a product such as 0.8 * 5 from rounding up past a whole number.
        F.ceil(q * F.lit(threshold) - 1e-9).cast("int").alias("need"),
    )


def _within(parts, tokens: Column):
    """Whether a hash belongs to the sketch of any of the size partitions."""

    def test(h: Column) -> Column:
        tests = [(h <= p["bound"]) & (F.size(tokens) >= p["least"]) for p in parts]
        return reduce(lambda a, b: a | b, tests)

    return test


def _slots(h: Column, bits: int) -> list[Column]:
    """The two places of a hash in a bit set, from its lower and its upper half."""
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def _bit_set(minima: DataFrame, count: int) -> tuple[Column, int]:
    """(constant array of 64-bit words, number of bits) that marks the hashes of all minima.

    What reaches the driver is a row per word with a mark: at most ``MOST_BITS`` / 64.
    """
    bits = 1024
    while bits < min(count * BITS_PER_MINIMUM, MOST_BITS):
        bits *= 2
    slot = F.explode(F.array(*_slots(F.col("hash"), bits)))
    merged = (
        minima.select(slot.alias("slot"))
        .select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63L as int))").alias("mark"))
        .groupBy("word")
        .agg(F.bit_or("mark").alias("mark"))
    )
    words_of = [0] * (bits // 64)
    for row in merged.collect():
        words_of[row["word"]] = row["mark"]
    # One string instead of an expression per word: the optimizer folds it to one constant.
    return F.split(F.lit(",".join(map(str, words_of))), ",").cast("array<bigint>"), bits


def _in_set(words_of: Column, bits: int):
    """Whether a hash may be one of the minima."""

    def test(h: Column) -> Column:
        found = [
            F.getbit(F.get(words_of, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1
            for slot in _slots(h, bits)
        ]
        return found[0] & found[1]

    return test


def _tagged(hashes: Column, width: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(width).alias("width"), h.alias("hash")))


def _minima(items: DataFrame) -> DataFrame:
    """The k smallest shingle hashes of each item."""
    hashed = items.select(
        "item",
        "width",
        "part",
        "need",
        F.array_sort(
            F.transform("shingles", lambda s: F.xxhash64(F.transform(F.split(s, " "), lambda w: F.xxhash64(w))))
        ).alias("hashes"),
    )
    k = F.size("hashes") - F.col("need") + 1
    return hashed.select(
        "item", "width", "part", "need", F.explode(F.slice("hashes", F.lit(1), k)).alias("hash")
    )


def _small_items(items: DataFrame) -> DataFrame:
    """The items computed once, hinted for broadcast if neither their rows nor their characters exceed the bounds."""
    kept = materialize(items)
    chars = F.aggregate("shingles", F.lit(0).cast("long"), lambda n, s: n + F.octet_length(s))
    total = kept.agg(F.count("*").alias("rows"), F.sum(chars).alias("chars")).first()
    fits = total["rows"] <= BROADCAST_ROWS and (total["chars"] or 0) <= BROADCAST_CHARS
    return F.broadcast(kept) if fits else kept


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    doc: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Pairs (doc, item) whose containment reaches the threshold, with the counts behind it.

    Returns doc, item, n_shingles (distinct ones of the item), n_shared, containment. Words are
    lower-cased and split at white space; shingles have five words. An item with fewer words is
    one shingle and is sought at its own width; an item without words is never found, and a
    document without words holds none. Equal items under several ids are each reported. Rows that
    repeat a document (same id and text) or an item give one pair; documents of one id but
    different texts give one row for each distinct count. Null ids are kept as null. Other columns
    are dropped.
    """
    return _leaks(docs, benchmark, threshold, doc, item, text).drop("_version").distinct()


def _leaks(docs: DataFrame, benchmark: DataFrame, threshold: float, doc: str, item: str, text: str) -> DataFrame:
    """The rows of :func:`find_leaks` with ``_version``, the hash of the text an item was found in."""
    items = _small_items(_items(benchmark, item, text, threshold))
    minima = materialize(_minima(items))
    minima_count = minima.count()
    if minima_count <= BROADCAST_ROWS:
        minima = F.broadcast(minima)
    # At most a row for each width and power of two: bounded whatever the number of items.
    plan = (
        minima.groupBy("width", "part")
        .agg(F.max("hash").alias("bound"), F.min("need").alias("least"))
        .collect()
    )
    source = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    if not plan:
        return source.limit(0).select(
            F.col("doc").alias(doc),
            F.lit(None).cast(benchmark.schema[item].dataType).alias(item),
            F.lit(0).alias("n_shingles"),
            F.lit(0).alias("n_shared"),
            F.lit(0.0).alias("containment"),
            F.xxhash64("text").alias("_version"),
        )

    known = _in_set(*_bit_set(minima, minima_count))

    def sketch(ws: Column) -> Column:
        """All hashes up to the bound of a size partition the document is large enough for, if in the bit set."""

        def kept(width: int):
            within = _within([r for r in plan if r["width"] == width], ws)
            return lambda h: within(h) & known(h)

        pieces = [
            _tagged(F.filter(shingle_hashes(ws, width), kept(width)), width)
            for width in sorted({row["width"] for row in plan})
        ]
        return pieces[0] if len(pieces) == 1 else F.concat(*pieces)

    found = (
        source.select(
            "doc",
            F.xxhash64("text").alias("version"),
            F.explode(let(words(F.col("text")), sketch)).alias("s"),
        )
        .select("doc", "version", F.col("s.width").alias("width"), F.col("s.hash").alias("hash"))
        .join(minima.select("item", "width", "hash"), ["width", "hash"])
        .select("doc", "version", "item")
        .distinct()
    )
    pairs = small(found, BROADCAST_ROWS)
    # Verification: the shingles of both sides, word for word.
    texts = source.withColumn("version", F.xxhash64("text"))
    matched = texts.join(
        pairs.withColumnRenamed("doc", "pair_doc").withColumnRenamed("version", "pair_version"),
        F.col("doc").eqNullSafe(F.col("pair_doc")) & (F.col("version") == F.col("pair_version")),
    ).select("doc", "version", "text", "item")
    against = matched.join(
        items.withColumnRenamed("item", "known"), F.col("item").eqNullSafe(F.col("known"))
    )
    tokens_now = words(F.col("text"))
    own = F.coalesce(
        *[
            F.when(F.col("width") == w, F.array_distinct(shingles(tokens_now, w)))
            for w in sorted({row["width"] for row in plan})
        ]
    )
    counted = against.select(
        F.col("doc").alias(doc),
        F.col("item").alias(item),
        "need",
        F.size("shingles").alias("n_shingles"),
        F.size(F.array_intersect("shingles", own)).alias("n_shared"),
        F.col("version").alias("_version"),
    )
    return counted.where(F.col("n_shared") >= F.col("need")).select(
        doc, item, "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"), "_version"
    )


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    doc: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """The rows in whose text no item is found, whatever other rows share their id; null ids are ids like any other."""
    found = _leaks(docs, benchmark, threshold, doc, item, text)
    leaked = small(found.select(F.col(doc).alias("_leaked"), "_version").distinct())
    same = docs[doc].eqNullSafe(leaked["_leaked"]) & (F.xxhash64(docs[text]) == leaked["_version"])
    return docs.join(leaked, same, "left_anti")


_OP6_SQL = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                              lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)
), its AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS s FROM i WHERE len(w) >= 5)
), q AS (SELECT item_id, CAST(count(*) AS INTEGER) AS n_shingles FROM its GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, CAST(count(*) AS INTEGER) AS n_shared,
       count(*) / n_shingles AS containment
FROM its JOIN ds USING (g) JOIN q USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= ceil(n_shingles * 0.8 - 1e-9)
"""


@query("op6_benchmark_leaks", _OP6_SQL)
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
