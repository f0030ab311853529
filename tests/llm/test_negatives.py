"""Hard negatives against brute force."""

import numpy as np
import pytest

from ledgersieve.llm.negatives import NormIndex, mine_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, draw int, v int, shard int, place int, highs int"


def plain_negatives(rows, every, positives, negatives, scale, low):
    used = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        used[(vec_id, label, tuple(int(np.floor(scale * x)) for x in vector))] = True
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for anchor, label, vector in used:
        if anchor % every:
            continue
        others = [(-score(vector, v), i, l) for i, l, v in used if i != anchor]
        for ps, positive, _ in sorted(o for o in others if o[2] == label)[:positives]:
            inside = sorted(o for o in others if o[2] != label and -low * ps <= -100 * o[0] <= -100 * ps)
            out += [(anchor, positive, rank, i, -ps, -ns) for rank, (ns, i, _) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(frame):
    return sorted(map(tuple, frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def some_rows(seed, count=600, dims=16, spread=0.3):
    """Clusters that labels only follow in part, so that positives and negatives lie close together."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    which = rng.integers(0, 12, count)
    points = centres[which] + spread * rng.normal(size=(count, dims))
    points[rng.random(points.shape) < 0.2] = 0
    labels = np.where(rng.random(count) < 0.7, which % 4, rng.integers(0, 4, count))
    return [(int(i), [float(x) for x in p], int(l)) for i, (p, l) in enumerate(zip(points, labels, strict=True))]


def test_negatives_are_those_of_all_pairs(spark):
    rows = some_rows(1) + some_rows(1)[:50]  # repeated rows
    rows += [(700, [0.0] * 16, 1), (800, [1.0, 2.0], 1), (801, [], 1), (805, [-5.0] * 16, 9), (900, [1.0] * 16, 99)]
    rows += [(None, [1.0] * 16, 1), (1000, None, 1), (1010, [1.0] * 16, None), (1020, [float("nan")] * 16, 1), (1030, [float("inf")], 1), (1040, [1.0, None], 1)]
    rows += [(20, [1.0] * 16, 3), (1100 + 7, rows[3][1], 2), (1100 + 3, rows[3][1], 2), (1100 + 1, rows[3][1], 1)]
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(5)
    expected = plain_negatives(rows, 10, 5, 5, 256, 80)
    assert len(expected) > 500
    assert found(mine_negatives(frame, every=10)) == expected
    assert found(mine_negatives(frame, every=10, shard_rows=100, anchor_rows=20)) == expected
    assert found(mine_negatives(frame, every=10, positives=2, negatives=900, low=-50)) == plain_negatives(rows, 10, 2, 900, 256, -50)
    assert mine_negatives(frame.limit(0)).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**20 + x for x in v], l) for i, v, l in some_rows(2, 80, 8)]
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)
    assert found(mine_negatives(frame, every=10, scale=512)) == plain_negatives(rows, 10, 5, 5, 512, 80)


@pytest.mark.parametrize("least", [-1e9, -50.0, 0.0, 10.0, 300.0, 2000.0, 1e9])
def test_join_finds_all_above_the_threshold(least):
    rng = np.random.default_rng(3)
    rows, queries = rng.integers(-20, 30, (300, 24)), rng.integers(-20, 30, (9, 24))
    rows[rng.random(rows.shape) < 0.4] = 0
    queries[3] = 0
    allowed = rng.random((9, 300)) < 0.9
    query, row, score = NormIndex(rows).join(queries, np.full(9, least), allowed)
    products = queries @ rows.T
    assert set(zip(query.tolist(), row.tolist(), strict=True)) == set(zip(*np.nonzero(allowed & (products >= least)), strict=True))
    assert (score == products[query, row]).all()


def test_bounds_leave_out_most_products_of_structured_rows():
    rows = np.array([[int(256 * x) for x in v] for _, v, _ in some_rows(4, 2000, 32, 0.1)])
    index = NormIndex(rows)
    top = np.array([np.sort(rows @ q)[-20] for q in rows[:40]], dtype=float)
    query, _, _ = index.join(rows[:40], top, np.ones((40, 2000), bool))
    assert (np.bincount(query) >= 20).all() and index.added < 0.8 * 40 * rows.size
