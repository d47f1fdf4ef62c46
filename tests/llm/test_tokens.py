"""Byte-level BPE and token files against the libraries themselves."""

import json
import random
import zlib

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from courtstats.llm import bpe, token_files
from courtstats.session import new_folder

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.multi_path()), special_tokens={}
    )


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(token_files.library_path())
    out.encode_special_tokens = True
    return out


def texts():
    rng = random.Random(1)
    letters = "ab's'tre'llvd  \n\t9é\xa0　!?.,'́Ⅷ中\U0001F600​\x1c\x85\r<|>"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    out += ["", "'s", "'", "''s", " 's", "\n's", "'s's", "a'", "'r", "'re", "  ", "a  b", "a \n b", "\n\n"]
    out += ["a" * 5000, "ab" * 3000, " " * 3000, "é" * 2000, "!?" * 2000, "'" * 999, "<|endoftext|> x<|endoftext|>"]
    return out + ["".join(rng.choice("abcdethn") for _ in range(n)) for n in range(40, 120)]


def ids_of(cache, values):
    return [i.tolist() for block in bpe.text_blocks(values, 5000) for i, _ in bpe.encode_block(block, cache)]


def test_ids_equal_the_libraries(plain, library):
    values = texts()
    assert ids_of(bpe._cache(bpe.multi_path()), values) == [plain.encode_ordinary(t) for t in values]
    expected = [e.ids for e in library.encode_batch(values, add_special_tokens=False)]
    assert ids_of(token_files.library_cache(token_files.library_path()), values) == expected


def test_every_code_point_has_the_library_s_class(plain):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0 or c % 64 == 39)]
    values = [f"a{chr(c)}a 1{chr(c)}1" for c in codes]
    assert ids_of(bpe._cache(bpe.multi_path()), values) == [plain.encode_ordinary(t) for t in values]


def test_scan_equals_a_step_by_step_walk():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 4097, 9000):
        functions = rng.integers(0, len(bpe.TABLE), n).astype(np.uint8)
        state, states = np.arange(bpe.STATES), []
        for f in functions:
            state = bpe.TABLE[f][state]
            states.append(state)
        assert (bpe.TABLE[bpe.scan(functions)] == np.array(states)).all()


def test_cache_stays_bounded():
    cache = bpe.PieceCache(lambda pieces: [[len(p)] for p in pieces], limit=10)
    for i in range(50):
        ids, counts = cache.lookup([b"x" * (i + 1), b"x"])
        assert ids.tolist() == [i + 1, 1] and counts.tolist() == [1, 1]
        assert len(cache.known) <= 12


def test_encode_and_decode(docs, samples, plain):
    path = bpe.multi_path()
    rows = bpe.decode(bpe.encode(docs, path, keep=["doc_id", "text"]), path).collect()
    assert len(rows) == len(samples)
    for r in rows:
        text = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
        ends = np.frombuffer(r.pieces, "<u4").reshape(-1, 2)
        assert len(ends) == 0 or ends[-1].tolist() == [len(text.encode()), len(r.ids) // 4]


def test_decode_refuses_foreign_offsets(spark):
    path = bpe.multi_path()
    df = bpe.encode(spark.createDataFrame([("one two",)], "text string"), path, keep=[])
    from pyspark.sql import functions as F

    other = df.withColumn("ids", F.expr("substring(ids, 5, 4)"))
    with pytest.raises(Exception, match="kept offsets"):
        bpe.decode(other, path).collect()


def test_no_rows(empty, spark):
    path = bpe.multi_path()
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0
    folder = new_folder(spark, "tokens")
    assert token_files.write_token_files(empty, folder, token_files.library_path())["parts"] == []
    assert token_files.read_token_files(spark, folder).count() == 0


def test_token_files(docs, samples, library, spark):
    folder = new_folder(spark, "tokens")
    manifest = token_files.write_token_files(docs, folder, token_files.library_path())
    assert manifest == token_files.read_manifest(folder) and json.dumps(manifest)
    order = sorted(
        samples, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), len(r[1] or ""))
    )
    expected, at = [], 0
    for key, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        expected.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in token_files.read_token_files(spark, folder).orderBy("start").collect()] == expected
    # A part that is written again is the same part.
    before = token_files.read_token_files(spark, folder).orderBy("start").collect()
    token_files.write_token_files(docs, folder, token_files.library_path())
    assert token_files.read_token_files(spark, folder).orderBy("start").collect() == before


def test_added_tokens_are_one_id(spark, tmp_path):
    """Against the library with its default settings, for the given file and for files with other tokens."""
    default = Tokenizer.from_file(token_files.library_path())
    end = "<|endoftext|>"
    values = [f"a {end} b", end, end + end, f"{end} x\n{end}", end[:-1], end[1:] + end, f"it'{end}s", "", " ", f"é {end}  "]
    values += texts() + [t + end + t[:7] for t in texts()[:200]]
    expected = [e.ids for e in default.encode_batch(values, add_special_tokens=False)]
    assert expected[0] == [64, 220, 50256, 275]
    got = [i.tolist() for b in bpe.text_blocks(values, 5000) for i in token_files.encode_texts(b, token_files.library_path())]
    assert got == expected
    with open(token_files.library_path()) as source:
        plain = json.load(source)
    token = plain["added_tokens"][0]
    more = [token | {"id": 50257, "content": "<|end"}, token | {"id": 50258, "content": "ab", "special": False}]
    for nr, change in enumerate(({}, {"lstrip": True, "rstrip": True}, {"single_word": True}, {"normalized": True})):
        path = str(tmp_path / f"{nr}.json")
        with open(path, "w") as out:
            json.dump(plain | {"added_tokens": [token, more[0], more[1] | change]}, out)
        tried = [*values, "ab", " ab ab", "xab ab.", f"ab{end}ab", "<|end|ab"]
        wanted = [e.ids for e in Tokenizer.from_file(path).encode_batch(tried, add_special_tokens=False)]
        assert [i.tolist() for i in token_files.encode_texts(tried, path)] == wanted


def test_token_files_with_an_added_token(spark):
    default = Tokenizer.from_file(token_files.library_path())
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "plain")]
    folder = new_folder(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), folder, token_files.library_path())
    at = 0
    for key, start, count, crc in token_files.read_token_files(spark, folder).orderBy("start").collect():
        ids = default.encode(dict(rows)[key], add_special_tokens=False).ids + [token_files.END_ID]
        assert (start, count, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += count


def test_wide_vocabularies_take_wide_files(spark, frame, tmp_path):
    """A vocabulary of 70,000 ids: the element type follows the file, and an id that doesn't fit raises."""
    raw = json.loads(open(token_files.library_path(), encoding="utf-8").read())
    raw["added_tokens"].append({**raw["added_tokens"][0], "id": 70_000, "content": "<wide>"})
    path = str(tmp_path / "wide.json")
    open(path, "w", encoding="utf-8").write(json.dumps(raw))
    if max(Tokenizer.from_file(path).get_vocab().values()) < 1 << 16:
        raw["model"]["vocab"].update({f"<filler{i}>": i for i in range(50_257, 70_001)})
        raw["added_tokens"][-1]["id"] = 70_001
        open(path, "w", encoding="utf-8").write(json.dumps(raw))
    assert token_files.id_type(path) == np.dtype("<u4")
    assert token_files.id_type(token_files.library_path(), 2) == np.dtype("<u2")
    folder = new_folder(spark, "wide")
    manifest = token_files.write_token_files(frame([(1, "a <wide> b")]), folder, path)
    assert manifest["dtype"] == "<u4"
    with pytest.raises(OverflowError):
        token_files.PartWriter(str(tmp_path / "narrow"), 0, np.dtype("<u2")).add(1, np.array([70_000], np.uint32))


def test_pieces_by_hash_are_those_by_bytes(monkeypatch):
    """Also where the table grows, where the cache is emptied, where all hashes collide, and for long blocks."""
    rng = random.Random(8)
    spell = lambda pieces: [[sum(p), len(p)] if len(p) != 3 else [] for p in pieces]

    def blocks():
        for _ in range(60):
            yield [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 200))]

    def same(cache, pieces):
        ends = np.cumsum([len(p) for p in pieces])
        ids, counts = cache.lookup_spans(b"".join(pieces), ends - [len(p) for p in pieces], ends)
        expected = spell(pieces)
        assert ids.tolist() == [i for x in expected for i in x] and counts.tolist() == [len(x) for x in expected]

    for limit in (10, 100_000):
        cache = bpe.PieceCache(spell, limit)
        cache.slots, cache.places = np.zeros(2, np.uint64), np.zeros(2, np.int32)
        for pieces in blocks():
            same(cache, pieces)
    real = bpe.span_hashes
    monkeypatch.setattr(bpe, "span_hashes", lambda d, a, b: real(d, a, b) & np.uint64(3) | np.uint64(1))
    cache = bpe.PieceCache(spell)
    for pieces in blocks():
        same(cache, pieces)
    monkeypatch.undo()
    monkeypatch.setattr(bpe, "SPAN_BYTES", 5)
    for pieces in blocks():
        same(bpe.PieceCache(spell), pieces)
