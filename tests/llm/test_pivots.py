"""The pivot elimination itself: bounds of very large numbers, blocks without a floor, several blocks of a table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import topk


def check_block(v, some, floors, pivots, k=20):
    ids, counts = np.arange(len(v)) * 3, {}
    q, found, s = topk.search_block(v[some], ids[some], floors, v, ids, pivots, k, counts)
    score = v.astype(object) @ v[some].T.astype(object)  # whole numbers of any size
    for j, own in enumerate(some):
        other = [i for i in range(len(v)) if i != own]
        want = sorted(((-score[i, j], int(ids[i])) for i in other))[:k]
        assert sorted(zip((-s[q == j]).tolist(), found[q == j].tolist()))[:k] == want
    return counts


@pytest.mark.parametrize("top", [2e8, 1e6, 50])
def test_large_numbers_with_and_without_floors(top):
    rng = np.random.default_rng(7)
    centres = rng.uniform(-top, top, (60, 16))
    v = np.floor(centres[rng.integers(0, 60, 1500)] + rng.normal(0, top / 1e4 + 1, (1500, 16))).astype(np.int64)
    some, pivots = np.arange(0, 1500, 25), v[rng.choice(1500, 64, replace=False)].astype(float)
    score = v.astype(object) @ v[some].T.astype(object)
    floors = np.array([sorted((score[i, j] for i in range(len(v)) if i != own), reverse=True)[19] for j, own in enumerate(some)], np.int64)
    check_block(v, some, floors, pivots)
    none = np.full(len(some), topk.NO_FLOOR)
    counts = check_block(v, some, none, pivots)
    assert counts["left"] < counts["there"]
    check_block(v, some[:3], none[:3], pivots, k=200)


def test_few_candidates_and_ties():
    v = np.array([[1, 2], [1, 2], [1, 2], [0, 0], [5, 5]] * 3)
    check_block(v, np.arange(5), np.full(5, topk.NO_FLOOR), v[:2].astype(float))
    check_block(np.zeros((900, 3), np.int64), np.arange(4), np.full(4, topk.NO_FLOOR), np.zeros((1, 3)))


def test_own_blocks_are_bounded_too():
    """Without a floor, copies of a few vectors are found by the pivots, not by evaluating all."""
    rng = np.random.default_rng(8)
    v = np.floor(64 * (rng.normal(0, 1, (40, 64))[rng.integers(0, 40, 2000)] + rng.normal(0, 0.01, (2000, 64)))).astype(np.int64)
    counts = check_block(v, np.arange(20), np.full(20, topk.NO_FLOOR), v[:64].astype(float))
    assert counts["evaluated"] < counts["there"] / 4


def test_several_blocks_of_a_table(spark):
    rng = np.random.default_rng(9)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(0, 1, (3 * topk.CANDIDATES, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("q", "block", "w", "floor", "a.b")})
    v = np.floor(64 * np.array([x for _, x in rows])).astype(np.int64)
    score = v @ v[::20].T
    want = set()
    for j, own in enumerate(range(0, len(v), 20)):
        score[own, j] = -(10**15)
        order = np.lexsort((np.arange(len(v)), -score[:, j]))[:5]
        want |= {(own, r + 1, int(i), int(score[i, j])) for r, i in enumerate(order)}
    assert set(map(tuple, topk.top_k(df, 5).collect())) == want
