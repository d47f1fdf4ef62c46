"""Token alignment against a plain walk over both libraries' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from courtstats.llm import alignment as al
from courtstats.llm.token_files import byte_letters

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def both():
    return al.Pair(al.library_path(), al.piece_path())


def tokens(both, text):
    """Ids and bytes of both tokenizers for a whole text."""
    letters = {ord(c): b for b, c in byte_letters().items()}
    a = both.a.encode(" " + text, add_special_tokens=False)
    b = both.b.encode(text)
    names = [both.b.id_to_piece(i) for i in b]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if both.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)
    ]
    return a.ids, [bytes(letters[ord(c)] for c in t) for t in a.tokens], b, b_bytes


def walk(both, text):
    """(n_a, n_b, groups, links as a counter) by stepping through both lists byte by byte."""
    if not text:
        return 0, 0, [], Counter()
    a, a_bytes, b, b_bytes = tokens(both, text)
    source = (" " + text).encode()
    if b"".join(a_bytes) != source or b"".join(b_bytes) != source:
        return 0, 0, [], Counter()
    groups, i, j, a_end, b_end, left, right = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if a_end <= b_end and i < len(a):
            a_end += len(a_bytes[i])
            left.append(a[i])
            i += 1
        else:
            b_end += len(b_bytes[j])
            right.append(b[j])
            j += 1
        if a_end == b_end:
            groups.append((left, right))
            left, right = [], []
    return len(a), len(b), groups, Counter((x, y) for g in groups for x in g[0] for y in g[1])


def digest(groups):
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


def odd_texts():
    rng = random.Random(3)
    letters = "ab's'tre'llvd  \n\t9é\xa0　!?.,'́Ⅷ中\U0001F600​\x1c\x85\r<|>▁\x00᠎﻿The "
    plain = "abcdethn     \n\n中文é. '"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    out += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    out += ["", " ", "a ", "  ", "a  ", "\n", " \n", "a \n b", "a" * 5000, " " * 3000, "中" * 3000]
    return out + ["<|endoftext|> x <s> </s><|endoftext|>", "▁", "a▁b", "it''s 'S", "x\n\n\ny \t z"]


def test_groups_equal_a_walk_over_whole_texts(both):
    texts = odd_texts()
    lost = 0
    for lo in range(0, len(texts), 500):
        block = texts[lo : lo + 500]
        sums, strings, pairs, times = both.align(block)
        for n, text in enumerate(block):
            n_a, n_b, groups, links = walk(both, text)
            assert sums[n].tolist() == [n_a, n_b, len(groups), sum(links.values())], repr(text)
            assert strings[n] == al.as_text(groups)
            assert dict(zip(pairs[n].tolist(), times[n].tolist())) == {a << 32 | b: c for (a, b), c in links.items()}
            lost += bool(text) and not groups
    assert lost  # some texts hold what B doesn't keep


def test_a_full_cache_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(al, "CACHE_UNITS", 20)
    small = al.Pair(al.library_path(), al.piece_path())
    texts = odd_texts()[3000:5000]
    for lo in range(0, len(texts), 250):
        mine, theirs = small.align(texts[lo : lo + 250]), both.align(texts[lo : lo + 250])
        assert mine[0].tolist() == theirs[0].tolist() and mine[1] == theirs[1]
        assert len(small.known) <= 20


def test_ends_in_windows_are_the_same(monkeypatch):
    rng = random.Random(4)
    for _ in range(200):
        a = sorted(rng.sample(range(1, 400), rng.randint(1, 90))) + [400]
        b = sorted(rng.sample(range(1, 400), rng.randint(1, 90))) + [400]
        monkeypatch.setattr(al, "WINDOW", rng.choice([1, 7, 50, 1000]))
        expected = [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]
        assert list(al.common_ends(a, b)) == expected


def test_links_of_large_groups_are_products():
    a, b = [1, 2, 1] * 30, [5, 6] * 40
    links = al.links_of([(a, b), ([1], [5])])
    assert links[1 << 32 | 5] == 60 * 40 + 1 and links[2 << 32 | 6] == 30 * 40 and sum(links.values()) == 90 * 80 + 1


def corpus_rows(both, data):
    """The query's rows by brute force."""
    walked = [(i, *walk(both, t or "")) for i, t in data]
    count = Counter(pair for _, _, _, _, links in walked for pair in links)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, n_a, n_b, groups, links in walked:
        best = sum(c for pair, c in links.items() if count[pair] == most[pair[0]])
        total = sum(c * count[pair] for pair, c in links.items())
        out.append((i, n_a, n_b, len(groups), sum(links.values()), best, total, digest(groups)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [al.HOT_PAIRS, 40, 0])
def test_query_rows_equal_brute_force(spark, frame, samples, both, rows, tmp_path, monkeypatch, hot):
    """All pairs sent to the tasks, some of them, or none."""
    data = [(i, t if t is None else t[:6000]) for i, t in samples] + [(900, "a▁b"), (901, "<|endoftext|> a")]
    monkeypatch.setattr(al.with_link_counts, "__defaults__", (hot,))
    frame(data).write.parquet(str(tmp_path / "documents.parquet"))
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert rows(al.op13_token_alignment(spark, str(tmp_path)), *columns) == corpus_rows(both, data)


def test_given_documents(spark, both, rows):
    import pyarrow.parquet as pq

    stored = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    got = rows(al.op13_token_alignment(spark, "/root/testdata/sf0.001"))
    assert got == corpus_rows(both, list(zip(stored["doc_id"], stored["text"])))


def test_operator_keeps_groups_and_other_columns(spark, docs, empty):
    kept = al.align(docs, al.library_path(), al.piece_path(), keep=["doc_id", "lang", "key"])
    row = kept.where("doc_id = 503").first()
    assert row["groups"].count("|") == row["n_groups"] == 1 and row["lang"] == "en" and row["key"] is None
    assert al.align(empty, al.library_path(), al.piece_path()).count() == 0


def test_frequent_pairs_keep_to_the_limit(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2] * 20 + [9] * 7 + [40] * 3)], "pair long, documents long")
    for limit in (0, 1, 3, 9, 10, 29, 30, 79):
        least = al.frequent(counts, limit)
        assert counts.where(counts.documents >= least).count() <= limit
    assert al.frequent(counts, 80) == 0 and al.frequent(counts, 10) <= 9
