"""Hard negatives and nearest neighbours against brute force over every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtstats.llm import hard_negatives as hn
from courtstats.llm import hashing_index as hi

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, key string, vec string, query int, cell long, rank int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, l, *(None,) * 6) for i, l, v in rows], schema).repartition(5)


def awkward(seed=1, count=600, dim=12):
    """Clusters, copies, a hot vector, ties, zeros, nulls, other lengths, large numbers and repeated rows."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(count):
        centre = rng.choice(centres)
        rows.append((i * 5, rng.randint(0, 3), [c + rng.gauss(0, 0.4) for c in centre]))
    hot = [x / 2 for x in centres[0]]
    rows += [(20_000 + 7 * i + 1, i % 2, hot) for i in range(200)]
    rows += [(50_000 + i, 1, [0.0] * dim) for i in range(3)] + [(50_100, 2, []), (50_200, 2, hot[:5])]
    rows += [(50_300, 0, None), (50_400, None, hot), (None, 0, hot), (50_500, 0, [math.nan] * dim)]
    rows += [(50_600, 0, [math.inf] + hot[1:]), (50_700, 0, [None] + hot[1:])]
    rows += [(60_000, 3, [3e3 * x for x in hot]), (60_001, 2, [3e3 * x for x in hot])]
    return rows + [rows[20], rows[20], rows[21], rows[-150]]


def finite(rows, label=True):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [r for r in rows if r[0] is not None and good(r[2]) and (not label or r[1] is not None)]
    width = max((len(r[2]) for r in kept), default=0)
    matrix = np.zeros((len(kept), width))
    for n, r in enumerate(kept):
        matrix[n, : len(r[2])] = np.array(r[2], np.float32)
    return np.array([r[0] for r in kept], np.int64), np.array([r[1] or 0 for r in kept], np.int64), matrix


def mined(rows, step=100):
    keys, labels, matrix = finite(rows)
    whole = np.floor(256 * matrix)
    out = []
    for a in np.flatnonzero(keys % step == 0):
        score = (whole @ whole[a]).astype(np.int64)
        order = np.lexsort((keys, -score))
        order = order[order != a]
        for p in order[labels[order] == labels[a]][:5]:
            others = order[labels[order] != labels[a]]
            inside = (80 * score[p] <= 100 * score[others]) & (score[others] <= score[p])
            for rank, n in enumerate(others[inside][:5], 1):
                out.append((keys[a], keys[p], rank, keys[n], score[p], score[n]))
    return sorted(tuple(map(int, r)) for r in out)


@pytest.mark.parametrize("seed", [1, 2])
def test_mined_rows_equal_brute_force(spark, rows, seed):
    data = awkward(seed)
    got = rows(hn.mine(table(spark, data), F.col("vec_id") % 100 == 0))
    assert sorted(got) == mined(data) and got


def test_mining_in_several_batches_and_small_blocks(spark, rows, monkeypatch):
    data = awkward(3, 300)
    monkeypatch.setattr(hn, "query_batches", lambda q: (b for b in _batches(q, 20)))
    got = rows(hn.mine(table(spark, data), F.col("vec_id") % 25 == 0))
    assert sorted(got) == mined(data, 25)


def _batches(queries, size):
    from courtstats.llm.vectors import query_batches

    found = list(query_batches(queries, size))
    assert len(found) > 1
    return found


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    for scale in (0.01, 1.0, 40.0):
        rows = hn.integers(np.concatenate([rng.normal(size=(300, 8)) * scale, np.zeros((2, 8)), np.ones((3, 8))]))
        references = hn.choose_references(rows, 6)
        lengths = hn.norms(rows)
        angles = hn.angles_to(rows, lengths, references)
        low, high = hn.score_bounds(angles, lengths, angles, lengths)
        exact = rows @ rows.T
        assert (low <= exact).all() and (exact <= high).all()
        assert (high < lengths[:, None] * lengths[None, :] * 0.5).any()  # they do rule pairs out


def test_angles_spare_most_scores_of_clustered_rows(spark, monkeypatch):
    """Only overlapping windows are scored: fewer than a third of all pairs in clusters."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16))
    vectors = centres[np.arange(800) % 8] + rng.normal(size=(800, 16)) * 0.05
    whole = hn.integers(vectors)
    lengths = hn.norms(whole)
    references = hn.choose_references(whole, hn.REFERENCES)
    angles = hn.angles_to(whole, lengths, references)
    _, high = hn.score_bounds(angles, lengths, angles, lengths)
    own = np.sort(whole @ whole.T, 1)[:, -6:-5]
    assert (high >= own).mean() < 1 / 3


def test_scores_beyond_doubles_are_exact():
    big = np.array([[2.0**30, 3.0, 2.0**29 + 1]])
    exact = sum(int(x) * int(x) for x in big[0])
    assert hn.scores(big, big[0], float(hn.norms(big)[0] ** 2)).tolist() == [exact]
    with pytest.raises(OverflowError):
        hn.scores(big * 2.0**4, big[0] * 2.0**4, 2.0**70)


def nearest(rows, step, count=5):
    keys, _, matrix = finite(rows, label=False)
    used = (matrix != 0).any(1)
    keys, matrix = keys[used], matrix[used]
    lengths = np.sqrt((matrix * matrix).sum(1))
    out = []
    for q in np.flatnonzero(keys % step == 0):
        cosine = (matrix * matrix[q]).sum(1) / (lengths * lengths[q])
        order = np.lexsort((keys, -cosine))
        for rank, n in enumerate(order[order != q][:count], 1):
            out.append((int(keys[q]), rank, int(keys[n]), float(cosine[n])))
    return out


@pytest.mark.parametrize("limit", [hi.SAMPLE_ROWS, 64])
def test_recall_and_scores(spark, rows, monkeypatch, limit):
    """Also with rotations and radii from a small sample of the rows."""
    monkeypatch.setattr(hi, "SAMPLE_ROWS", limit)
    data = awkward(4)
    got = rows(hi.nearest(table(spark, data), F.col("vec_id") % 50 == 0))
    expected = nearest(data, 50)
    assert len(got) == len(expected)
    scores = sorted((q, r, round(s, 12)) for q, r, _, s in expected)
    found = sorted((q, r, round(s, 12)) for q, r, _, s in got)
    assert len(set(scores) & set(found)) >= 0.9 * len(set(scores))
    hit = {(q, k) for q, _, k, _ in got} & {(q, k) for q, _, k, _ in expected}
    assert len(hit) >= 0.9 * len({(q, k) for q, _, k, _ in expected})


def test_recall_on_the_given_vectors(spark, rows):
    import pyarrow.parquet as pq

    stored = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    data = list(zip(stored["vec_id"], stored["label"], stored["embedding"]))
    got = {(q, k): s for q, _, k, s in rows(hi.op12_nearest_neighbours(spark, "/root/testdata/sf0.1"))}
    expected = {(q, k): s for q, _, k, s in nearest(data, 50)}
    hit = got.keys() & expected.keys()
    assert len(got) == len(expected) and len(hit) >= 0.9 * len(expected)
    assert all(abs(got[x] - expected[x]) < 1e-12 for x in hit)


def test_probing_retrieves_exactly_the_codes_within_a_radius():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 16, (1, hi.PARTS)).astype(np.uint16)
    flips = rng.random((900, hi.BITS)) < rng.random((900, 1)) * 0.4
    codes = centre ^ np.packbits(flips, axis=1, bitorder="little").view("<u2")
    block = hi.Block.__new__(hi.Block)
    block.uids, block.codes = np.arange(900), codes
    block.orders = np.argsort(codes, axis=0, kind="stable").T.astype(np.uint16)
    block.sorted = np.take_along_axis(codes.T, block.orders.astype(np.int64), 1)
    true = hi.distances(codes, centre[0])
    for radius in (0, 1, 15, 16, 17, 31, 40, 90, 128, 256):
        assert block.within(centre[0], radius).tolist() == np.flatnonzero(true <= radius).tolist()


def test_learnt_rotations_are_orthogonal_and_closer_to_signs():
    rng = np.random.default_rng(4)
    units = hi.units_of(rng.normal(size=(500, 32)) * np.linspace(3, 0.2, 32))
    turns = hi.learn_rotations(units)
    assert turns.shape == (32, hi.BITS)
    assert np.allclose(turns[:, :32].T @ turns[:, :32], np.eye(32))

    def error(r):
        seen = units @ r
        return ((np.where(seen >= 0, 1, -1) / np.sqrt(32) - seen) ** 2).sum()

    random_turn, _ = np.linalg.qr(np.random.default_rng(9).standard_normal((32, 32)))
    assert error(turns[:, :32]) < error(random_turn)
    wide = hi.units_of(rng.normal(size=(300, 400)))
    assert hi.learn_rotations(wide).shape == (400, hi.BITS)


def test_few_or_no_rows(spark, rows):
    empty = table(spark, [])
    anchors, queries = F.col("vec_id") % 100 == 0, F.col("vec_id") % 50 == 0
    assert rows(hn.mine(empty, anchors)) == [] and rows(hi.nearest(empty, queries)) == []
    lone = table(spark, [(100, 1, [1.0, 2.0])])
    assert rows(hn.mine(lone, anchors)) == [] and rows(hi.nearest(lone, queries)) == []
    hollow = table(spark, [(100, 1, []), (200, 1, []), (300, 2, [])])
    assert rows(hi.nearest(hollow, queries)) == []
    assert rows(hn.mine(hollow, anchors)) == mined([(100, 1, []), (200, 1, []), (300, 2, [])])
    three = table(spark, [(100, 1, [1.0, 2.0]), (50, 1, [2.0, 1.0]), (51, None, [0.0, 1.0])])
    got = rows(hi.nearest(three, queries), "query_id", "rank", "vec_id")
    assert sorted(got) == [(50, 1, 100), (50, 2, 51), (100, 1, 51), (100, 2, 50)]


def test_very_large_and_small_components_keep_their_cosine(spark, rows):
    schema = SCHEMA.replace("array<float>", "array<double>")
    data = [(0, 1, [1e200, 2e200]), (1, 1, [1e-200, 2e-200]), (2, 1, [2.0, 1.0])]
    got = rows(hi.nearest(table(spark, data, schema), F.col("vec_id") == 0))
    assert [(r[0], r[1], r[2], round(r[3], 9)) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 0.8)]
