"""Token files: flat unsigned integers with 64-bit document offsets, written by many tasks, memory-mapped.

A set of files lies in one folder that all executors share. Every task writes one part: ``part-N.bin``
holds the ids of its documents one after the other (uint16 if the vocabulary fits, else uint32,
little-endian), ``part-N.idx`` the 64-bit end of every document counted from the part's own start,
their 64-bit ids and a byte that tells null ids. Parts follow the order of the document id.
``parts.json`` lists the parts with their bases: the ids before a part, which are prefix sums over
the parts' totals, so no task has to wait for another. A document's place in the whole stream is the base of its
part plus its local offset.

A part is written under a name of its attempt and renamed when it is complete, so a task that is
repeated after the loss of an executor replaces its part by an equal one.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import new_folder

from .bpe import PieceCache, encode_block, text_blocks
from .common import query, read, small_batches

#: Distinct pieces a worker keeps: about 200 bytes each.
LIBRARY_PIECES = 1_200_000
#: Id appended to every document by the query.
END_ID = 2


# --- Files ------------------------------------------------------------------------------


def _file_system(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder named by a path or a URI."""
    if urlparse(folder).scheme in ("", "file"):
        return arrow_fs.LocalFileSystem(), urlparse(folder).path
    # Spark's names of object stores that Arrow calls otherwise.
    return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


class PartWriter:
    """Writes one part, a buffer at a time; ``close`` makes it visible."""

    def __init__(self, folder: str, part: int, dtype: np.dtype):
        self.fs, root = _file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = f"{root}/part-{part:06d}"
        self.attempt = f"{root}/attempt-{uuid.uuid4().hex}"
        self.dtype = dtype
        self.stream = self.fs.open_output_stream(self.attempt + ".bin")
        self.ends: list[int] = []
        self.keys: list[int | None] = []
        self.total = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) > np.iinfo(self.dtype).max:
            raise OverflowError(f"id {ids.max()} doesn't fit {self.dtype}")
        self.stream.write(ids.astype(self.dtype).tobytes())
        self.total += len(ids)
        self.ends.append(self.total)
        self.keys.append(key)

    def close(self) -> None:
        self.stream.close()
        nulls = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        with self.fs.open_output_stream(self.attempt + ".idx") as index:
            index.write(np.array(self.ends, "<i8").tobytes() + keys.tobytes() + nulls.tobytes())
        # The index is moved last: a part with an index is complete.
        for suffix in (".bin", ".idx"):
            self.fs.move(self.attempt + suffix, self.final + suffix)


class Part:
    """A part opened for reading; local files are memory-mapped."""

    def __init__(self, folder: str, part: int, docs: int, dtype: np.dtype):
        fs, root = _file_system(folder)
        name = f"{root}/part-{part:06d}"
        if isinstance(fs, arrow_fs.LocalFileSystem):
            size = os.path.getsize(name + ".bin")
            self.ids = np.memmap(name + ".bin", dtype, "r") if size else np.zeros(0, dtype)
            with open(name + ".idx", "rb") as index:
                raw = index.read()
        else:
            with fs.open_input_file(name + ".bin") as data:
                self.ids = np.frombuffer(data.read_buffer(), dtype)
            with fs.open_input_file(name + ".idx") as index:
                raw = index.read()
        self.ends = np.frombuffer(raw, "<i8", docs)
        self.keys = np.frombuffer(raw, "<i8", docs, 8 * docs)
        self.nulls = np.frombuffer(raw, np.uint8, docs, 16 * docs)

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, local start, ids) of every document."""
        begin = 0
        for end, key, null in zip(self.ends.tolist(), self.keys.tolist(), self.nulls.tolist()):
            yield (None if null else key), begin, self.ids[begin:end]
            begin = end


# --- Operators --------------------------------------------------------------------------

_LIBRARY: dict[str, PieceCache] = {}


def library_cache(path: str) -> PieceCache:
    """Cache of pieces, filled by the model of the tokenizers library.

    The library cuts a text into pieces by the byte-level pattern and merges each by itself, so a
    distinct piece needs to be merged once. Only tokenizers that do nothing else to a text are taken.
    Pieces know nothing of added tokens: :func:`encode_texts` cuts texts at these first.
    """
    if path not in _LIBRARY:
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.normalizer is not None or not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError(f"{path} isn't a plain byte-level tokenizer")
        model, letters = tokenizer.model, byte_letters()
        _LIBRARY[path] = PieceCache(
            lambda pieces: (
                [token.id for token in model.tokenize(p.decode("latin-1").translate(letters))] for p in pieces
            ),
            LIBRARY_PIECES,
        )
    return _LIBRARY[path]


class AddedTokens:
    """The added tokens of a tokenizers file: strings that become one id wherever they occur in a text.

    Of several at one place the longest counts. ``pattern`` is None if a token has options (whole words,
    white space around it) or tokens are sought in two passes; then the library encodes the texts that hold one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder()
        self.ids = {t.content: i for i, t in tokens.items() if t.content}
        odd = any(t.single_word or t.lstrip or t.rstrip for t in tokens.values())
        longest = sorted(self.ids, key=len, reverse=True)
        plain = not odd and len({t.normalized for t in tokens.values()}) == 1
        self.pattern = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if plain else None

    def met(self, text: str) -> bool:
        return any(content in text for content in self.ids)


_ADDED: dict[str, AddedTokens] = {}


def encode_texts(texts: list[str], path: str) -> Iterator[np.ndarray]:
    """Ids of every text, as the library as loaded from ``path`` gives them without its special tokens around.

    Texts without an added token, and what lies between added tokens, are encoded by pieces.
    """
    if path not in _ADDED:
        _ADDED[path] = AddedTokens(path)
    cache, added = library_cache(path), _ADDED[path]
    parts: list[str] = []  # ordinary strings of all texts
    plans: list[list[int | None]] = []  # per text: None for the next string, or the id of a token
    whole: dict[int, list[int]] = {}
    for n, text in enumerate(texts):
        plan: list[int | None] = [None]
        if not added.met(text):
            parts.append(text)
        elif added.pattern is None:
            plan, whole[n] = [], added.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            # Even places hold the strings between tokens, odd ones the tokens.
            cut = added.pattern.split(text)
            parts += cut[::2]
            plan = [None if k % 2 == 0 else added.ids[piece] for k, piece in enumerate(cut)]
        plans.append(plan)
    coded = (ids for ids, _ in encode_block(parts, cache))
    for n, plan in enumerate(plans):
        if n in whole:
            yield np.array(whole[n], np.uint32)
        elif len(plan) == 1:
            yield next(coded)
        else:
            yield np.concatenate([next(coded) if i is None else np.array([i], np.uint32) for i in plan])


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others take the characters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def id_type(path: str, end_id: int | None = None) -> np.dtype:
    """The narrowest of both element types that holds every id of a tokenizers file, its added tokens included."""
    from tokenizers import Tokenizer

    largest = max([*Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), end_id or 0])
    if largest >= 1 << 32:
        raise OverflowError(f"id {largest} of {path} doesn't fit 32 bits")
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def write_token_files(
    df: DataFrame,
    folder: str,
    path: str,
    end_id: int | None = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> dict:
    """Encode all texts with a tokenizers file and write them in ascending order of the key.

    Ids are those of the library with its default settings: an added token in a text is its one id.
    Returns what ``parts.json`` holds: the element type, and per part its number, documents, ids
    and base. Null and empty texts become documents without ids (but for ``end_id``). Null keys come
    first; ties are ordered by checksum and length of the text, equal rows stay as several
    documents. Other columns are dropped. An empty table gives no parts.
    """
    dtype = id_type(path, end_id)
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    by = ["key", F.crc32(F.col("text").cast("binary")), F.length("text")]
    # A key that holds most rows is dealt out by its other columns and a seeded number.
    ordered = rows.withColumn("tie", F.rand(7)).repartitionByRange(*by, "tie").sortWithinPartitions(*by, "tie")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer = None
        for batch in batches:
            keys = batch.column("key").to_pylist()
            at = 0
            for block in text_blocks(batch.column("text")):
                writer = writer or PartWriter(folder, part, dtype)
                for ids in encode_texts(block, path):
                    writer.add(keys[at], np.concatenate([ids, tail]))
                    at += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "docs": [len(writer.ends)], "ids": [writer.total]}
            )

    totals = ordered.select("key", "text").transform(small_batches).mapInArrow(write, "part long, docs long, ids long").toPandas()
    totals = totals.sort_values("part")
    bases = totals["ids"].cumsum() - totals["ids"]
    manifest = {
        "dtype": dtype.str,
        "parts": [
            {"part": int(p), "docs": int(d), "ids": int(n), "base": int(b)}
            for p, d, n, b in zip(totals["part"], totals["docs"], totals["ids"], bases)
        ],
    }
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/parts.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, root = _file_system(folder)
    with fs.open_input_file(f"{root}/parts.json") as source:
        return json.loads(source.read())


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """
    manifest = read_manifest(folder)
    dtype = np.dtype(manifest["dtype"])
    parts = [(p["part"], p["docs"], p["base"]) for p in manifest["parts"]]
    listed = spark.createDataFrame(parts, "part long, docs long, base long")

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, docs, base in batch.itertuples(index=False):
                rows = [
                    (key, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for key, start, ids in Part(folder, part, docs, dtype)
                ]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype(
                    {"doc_id": "Int64"}
                )

    return listed.repartition(max(1, len(parts)), "part").mapInPandas(
        scan, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def library_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files, and read back from them."""
    folder = new_folder(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), folder, library_path())
    return read_token_files(spark, folder)
