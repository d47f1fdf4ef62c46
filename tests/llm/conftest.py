"""Small documents with every awkward case, and extra columns whose names operators use inside."""

import random

import pytest

EXTRA = ("key", "version", "hash", "fp", "_key", "_text", "spans", "item", "shard", "_label", "id", "leaked")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def samples():
    """(doc_id, text): copies, near copies, shared lines, nulls, blanks, a very long text, repeated rows."""
    rng = random.Random(5)
    passage = "\n".join(words(rng, n) for n in (20, 14, 39))
    base = [words(rng, rng.randint(1, 90)) for _ in range(30)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + i, base[i]) for i in range(5)]
    rows += [(300 + i, base[20] + " " + words(rng, 1)) for i in range(4)]
    rows += [(400 + i, words(rng, 12) + "\n" + passage + "\n" + words(rng, 9)) for i in range(6)]
    rows += [(500, None), (501, ""), (502, " \t\n "), (503, "x"), (504, "A b"), (None, words(rng, 30)), (None, None)]
    rows += [(505, words(rng, 20_000)), (506, "a" * 50_000), (507, "'" * 3_000), (508, "1.2.3.4 " * 400)]
    rows += [(100, base[0]), (100, base[0]), (101, base[7])]
    rows += [(600, "same\n" * 50), (601, "MAIL a.b@c.de, +1 (415) 555-2671, 4111 1111 1111 1111, 10.0.0.1 \U0001F600 ß")]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text) rows; every extra column holds nulls."""

    def make(rows):
        extra = ", ".join(f"{c} string" for c in EXTRA)
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
        blank = (None,) * len(EXTRA)
        full = [(i, t, "en", "s", None if t is None else len(t), *blank) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def docs(frame, samples):
    return frame(samples)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
