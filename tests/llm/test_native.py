"""Chat formatting, decontamination and sharding against plain Python."""

import hashlib
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from courtstats.llm import chat, decontaminate, sharding


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --- Chat formatting --------------------------------------------------------------------

TALKS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a\\<|end|>b"), (1, 2, "assistant", "\\\\<|\\|>"),
    (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, 0, "assistant", "first"), (3, 1, "user", "<|turn|>x<|text|>"),
    (4, 0, "user", "q"), (4, 1, "user", "q"), (4, 1, "user", "q"), (4, None, "assistant", "no number"),
    (5, 0, None, "no role"), (None, 0, "user", "no id"), (None, 1, "assistant", "\n\t é \U0001F600"),
    *[(6, i, "user" if i % 2 == 0 else "assistant", f"turn {i} " * 50) for i in range(300)],
]


@pytest.fixture(scope="module")
def talks(spark):
    schema = "conv_id long, turn long, role string, text string, segments string, t string, valid string"
    return spark.createDataFrame([(*r, None, None, None) for r in TALKS], schema).repartition(4)


def expected_turns(conv):
    own = [r for r in TALKS if r[0] == conv]
    own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    return [(r[2] or "", r[3] or "") for r in own]



def test_long_conversations_take_linear_time(spark):
    """Turns by the ten thousand: spans and the text read back are right, and four times as many take about that long."""
    took = {}
    for n in (10_000, 40_000):
        turns = spark.range(n).select(
            F.lit(1).alias("conv_id"),
            F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
            F.concat(F.lit("\U0001F600<|x \\ "), F.col("id"), F.repeat(F.lit("y\n"), (F.col("id") % 300).cast("int"))).alias("text"),
        )
        begun = time.perf_counter()
        made = chat.format_chats(turns)
        row = made.select(
            F.sha2(chat.loss_text(F.col("formatted"), F.col("loss_spans")), 256).alias("loss"),
            F.size("loss_spans").alias("n"),
            F.size(chat.parse_turns(F.col("formatted"))).alias("turns"),
            "valid",
        ).first()
        took[n] = time.perf_counter() - begun
        wanted = "".join("\U0001F600<|x \\ %d" % i + "y\n" * (i % 300) for i in range(1, n, 2))
        assert row["loss"] == hashlib.sha256(wanted.encode()).hexdigest()
        assert (row["n"], row["turns"], row["valid"]) == (n // 2, n, True)
    assert took[40_000] < 10 * took[10_000] + 5


def test_spans_across_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    monkeypatch.setattr(chat, "PIECE", 3)
    texts = ["", "a", "abc", "\U0001F600" * 7, "<|end|>", "\\", "abcdef" * 5, ""]
    rows = [(1, 2 * i + k, role, t) for i, t in enumerate(texts) for k, role in enumerate(("user", "assistant"))]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = chat.format_chats(talks).select(
        "formatted", "loss_spans", chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    ).first()
    assert row["loss"] == "".join(texts)
    plain = chat.Template()
    cut = [row["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]] for s in row["loss_spans"]]
    assert cut == [t.replace("\\", "\\\\").replace("<|", "<\\|") for t in texts] and plain.mark == "<|"


def test_turns_and_loss_are_read_back(talks):
    made = chat.format_chats(talks)
    back = made.select(
        "conv_id",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    rows = back.collect()
    assert {r.conv_id for r in rows} == {r[0] for r in TALKS} and len(rows) == 7
    for r in rows:
        turns = expected_turns(r.conv_id)
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == "".join(text for role, text in turns if role == "assistant")


def test_state_machine(talks):
    verdict = {r.conv_id: (r.valid, r.first_wrong) for r in chat.format_chats(talks).collect()}
    assert verdict[1] == (True, None) and verdict[2] == (True, None) and verdict[6] == (True, None)
    assert verdict[3] == (False, 0)
    assert verdict[4] == (False, 0)  # the turn without a number comes first
    assert verdict[5] == (False, 0)


def test_another_template(spark):
    template = chat.Template(
        mark="[[", open="[[a]]", middle="[[b]]", close="[[c]]", learnt=("user", "assistant"),
        turns={"": ("user",), "user": ("assistant",), "assistant": ()},
    )
    df = spark.createDataFrame([(1, 0, "user", "[[c]] \\[["), (1, 1, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df, template).select(
        "valid",
        chat.parse_turns(F.col("formatted"), template).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans"), template).alias("loss"),
    ).first()
    assert row.valid and row.loss == "[[c]] \\[[ok" and [t.text for t in row.turns] == ["[[c]] \\[[", "ok"]
    with pytest.raises(ValueError):
        chat.Template(open="turn")


def test_chat_is_native_and_takes_no_rows(talks, spark):
    assert "Python" not in executed(chat.format_chats(talks))
    assert chat.format_chats(talks.limit(0)).count() == 0


# --- Decontamination --------------------------------------------------------------------


def shingle_set(text, width):
    w = [x for x in re.split("[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {" ".join(w[i : i + width]) for i in range(len(w) - width + 1)}


def leaks(rows, items, threshold=0.8):
    out = set()
    for item, text in items:
        n = len([x for x in re.split("[\x20\x09-\x0D]+", (text or "").lower()) if x])
        if not n:
            continue
        width = min(n, 5)
        own = shingle_set(text, width)
        for doc, body in rows:
            shared = len(own & shingle_set(body, width))
            if shared >= threshold * len(own) - 1e-9:
                out.add((doc, item, len(own), shared))
    return out


@pytest.fixture(scope="module")
def items(samples):
    texts = [t for i, t in samples if i and 100 <= i < 130]
    long = next(t for i, t in samples if i == 505).split()
    return [
        (1, texts[3]), (2, texts[3]), (3, "x"), (4, None), (5, ""), (6, " ".join(long[9000:9040])),
        (7, " ".join(long[100:130] + ["zz"] * 4 + long[134:150])), (8, " ".join(texts[5].upper().split()[:3])),
        (9, "not in any of them at all"), (None, texts[8]), (10, " ".join(long[5:25] + ["y"] * 20)), (1, texts[3]),
    ]


def test_leaks_equal_brute_force(docs, samples, items, spark):
    bench = spark.createDataFrame([(*i, None, None) for i in items], "item_id long, text string, doc string, hash string")
    found = decontaminate.find_leaks(docs, bench)
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found.collect()}
    assert got == leaks(samples, items)
    assert found.count() == len(got)
    assert "Python" not in executed(found)
    kept = {(r.doc_id, r.text) for r in decontaminate.remove_leaks(docs, bench).collect()}
    gone = {d for d, *_ in got}
    assert kept == {(i, t) for i, t in samples if i not in gone}


def test_a_leak_takes_its_own_text_only(frame, spark):
    """Rows that share an id, or have none, with a text that holds an item."""
    item = "one two three four five six seven"
    rows = [(i, f"clean text number {n} of this id") for i in (None, 1, 2) for n in range(20)]
    bad = [(None, f"a {item} b"), (1, item), (1, item), (3, item.upper())]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.remove_leaks(frame([*rows, *bad, (4, None)]), bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([*rows, (4, None)], key=repr)
    other = frame([*rows, *bad]).withColumnsRenamed({"doc_id": "nr", "text": "body"})
    items = bench.withColumnsRenamed({"text": "body"})
    assert decontaminate.remove_leaks(other, items, doc="nr", text="body").count() == len(rows)


def test_leaks_without_rows(docs, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.find_leaks(empty, one).count() == 0
    assert decontaminate.remove_leaks(docs, none).count() == docs.count()


# --- Shards -----------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_shards_are_contiguous_and_balanced(docs, samples, shards):
    rows = sharding.shard_by_bytes(docs, shards).collect()
    order = sorted(
        samples, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()))
    )
    total = sum(len((t or "").encode()) + 8 for _, t in samples)
    expected, before, slots = [], 0, {}
    for key, text in order:
        raw = (text or "").encode()
        size = len(raw) + 8
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        before += size
        slots[shard] = slots.get(shard, -1) + 1
        expected.append((key, size, zlib.crc32(raw), shard, slots[shard]))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_shards_of_one_key_and_of_nothing(frame, empty):
    same = sharding.shard_by_bytes(frame([(7, "equal rows")] * 200), 4).collect()
    assert sorted((r.shard, r.slot) for r in same) == [(s, i) for s in range(4) for i in range(50)]
    assert sharding.shard_by_bytes(empty).count() == 0


def test_shards_are_native(docs):
    assert "Python" not in executed(sharding.shard_by_bytes(docs))


def test_probe_survives(spark, tmp_path):
    talks = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    talks.write.parquet(str(tmp_path / "conversations.parquet"))
    row = chat.op3_chat_format(spark, str(tmp_path)).where("conv_id = -1").first()
    text = chat.PROBE
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text)


def test_scan_lets_few_hashes_pass(spark):
    """Of all shingle hashes of the documents the scan passes at most twice those that are minima of items."""
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    items = decontaminate._items(read("benchmark"), "item_id", "text", 0.8)
    minima = decontaminate._minima(items).cache()
    known = decontaminate._in_set(*decontaminate._bit_set(minima, minima.count()))
    hashes = read("documents").select(
        F.explode(
            decontaminate.let(decontaminate.words(F.col("text")), lambda ws: decontaminate.shingle_hashes(ws, 5))
        ).alias("hash")
    )
    true = minima.where("width = 5").select("hash").distinct().withColumn("is", F.lit(True))
    row = (
        hashes.join(F.broadcast(true), "hash", "left")
        .agg(
            F.count_if(F.col("is") & known(F.col("hash"))).alias("found"),
            F.count_if(F.col("is")).alias("all"),
            F.count_if(known(F.col("hash"))).alias("passed"),
        )
        .first()
    )
    assert row["found"] == row["all"] > 0 and row["passed"] <= 2 * row["all"], row
    minima.unpersist()
