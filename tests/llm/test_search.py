"""Exact and approximate search against brute force."""

from pathlib import Path

import numpy as np
import pytest

from ledgersieve.llm.ann import ListBlock, fit_lists, nearest_by_cosine
from ledgersieve.llm.mtree import MTree, top_inner_products
from ledgersieve.llm.queries import all_queries

FOLDER = "/root/testdata/sf0.1"


def frame(spark, rows, parts=4):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return made.selectExpr("*", "1 AS rank", "2.0 AS score").repartition(parts)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    points = rng.normal(size=(900, 12)) * rng.choice([0.2, 1, 3], size=(900, 1))
    points[300:600] = points[0]
    return [(i, [float(x) for x in p]) for i, p in enumerate(points)]


ODD = [
    (1000, None), (1100, []), (1200, [float("nan")] * 12), (1300, [float("inf")] + [0.0] * 11), (1400, [None] + [1.0] * 11),
    (1500, [0.0] * 12), (1600, [0.5] * 5), (None, [1.0] * 12),
]


def plain_top(rows, every, k):
    held = {i: np.floor(1024.0 * np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    padded = {i: np.pad(v, (0, 12 - len(v))) for i, v in held.items()}
    out = []
    for query in sorted(i for i in padded if i % every == 0):
        scored = sorted((-int(padded[query] @ v), i) for i, v in padded.items() if i != query)[:k]
        out += [(query, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
    return out


def test_top_k_is_exact(spark, rows):
    given = rows + ODD + rows[:5]
    for shard_rows, query_rows in ((16_384, 8_192), (150, 4)):
        found = top_inner_products(frame(spark, given), 100, 10, shard_rows=shard_rows, query_rows=query_rows).collect()
        assert sorted(map(tuple, found)) == plain_top(given, 100, 10)


def test_top_k_of_few_rows(spark, rows):
    assert top_inner_products(frame(spark, []), 100, 10).collect() == []
    assert sorted(map(tuple, top_inner_products(frame(spark, rows[:3]), 100, 10).collect())) == plain_top(rows[:3], 100, 10)


def test_tree_leaves_out_distances():
    rng = np.random.default_rng(9)
    centres = rng.integers(-3000, 3000, (40, 6))
    points = centres[rng.integers(0, 40, 8000)] + rng.integers(-20, 20, (8000, 6))
    tree = MTree(points, np.arange(8000), page_rows=64)
    for query in points[:20]:
        exact = sorted(((int(query @ p), -i) for i, p in enumerate(points)), reverse=True)[:10]
        assert [(s, -i) for s, i in tree.search(query, -1, 10)] == exact
    assert tree.distances < 0.6 * 20 * 8000


def test_large_numbers_stay_exact():
    points = np.array([[2**31, 1], [2**31, 2], [2**31, 3], [5, 5]], dtype=np.int64)
    tree = MTree(points, np.array([1, 2, 3, 4]))
    assert tree.search(np.array([2**30, 1]), 9, 3) == [(2**61 + 3, 3), (2**61 + 2, 2), (2**61 + 1, 1)]


def plain_nearest(rows, every, k):
    held = {i: np.pad(np.array(v, np.float32).astype(float), (0, 12 - len(v))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for query in (i for i in held if i % every == 0):
        q = held[query]
        scored = sorted((-(q * v).sum() / np.sqrt((q * q).sum() * (v * v).sum()), i) for i, v in held.items() if i != query)
        out[query] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_and_scores(spark, rows):
    given = rows + ODD + rows[:5]
    expected = plain_nearest(given, 50, 5)
    truth = {query: dict(near) for query, near in plain_nearest(given, 50, 2000).items()}
    for block_rows in (8_192, 60):
        found = nearest_by_cosine(frame(spark, given), 50, 5, block_rows=block_rows, query_rows=7).collect()
        by_query = {}
        for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
            by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert set(by_query) == set(expected)
        hits = sum(len({i for i, _ in by_query[q]} & {i for i, _ in expected[q]}) for q in expected)
        assert hits >= 0.9 * 5 * len(expected)
        for query, near in by_query.items():
            assert len(near) == 5 and [s for _, s in near] == sorted((s for _, s in near), reverse=True)
            assert all(abs(truth[query][i] - s) < 1e-12 for i, s in near)


def test_nearest_of_few_rows(spark, rows):
    assert nearest_by_cosine(frame(spark, []), 50, 5).collect() == []
    found = sorted(map(tuple, nearest_by_cosine(frame(spark, rows[:4]), 50, 5).collect()))
    assert [(q, rank, i) for q, rank, i, _ in found] == [(0, n, i) for n, (i, _) in enumerate(plain_nearest(rows[:4], 50, 5)[0], 1)]


def test_scan_gives_up_dimensions():
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(30, 64))
    points = centres[rng.integers(0, 30, 4000)] + rng.normal(size=(4000, 64)) * 0.3
    model = fit_lists(points, 30)
    block = ListBlock(points, np.arange(4000), model.rotation)
    unit = points / np.sqrt((points * points).sum(axis=1, keepdims=True))
    hits = 0
    for number in range(50):
        found = block.search(points[number], unit[number] @ model.rotation, number, 5, 2.1)
        cosines = unit @ unit[number]
        cosines[number] = -2
        hits += len({i for _, i in found} & set(np.argsort(-cosines, kind="stable")[:5].tolist()))
    assert hits >= 0.95 * 250 and block.read < 0.7 * 50 * 4000 * 64


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")
def test_recall_on_the_given_vectors(spark):
    found = {}
    for r in all_queries()["op5_adaptive_scan"](spark, FOLDER).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    usable = [(r.vec_id, r.embedding) for r in rows if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    ids, points = np.array([i for i, _ in usable]), np.array([v for _, v in usable])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        cosines = unit @ unit[at]
        cosines[ids == ids[at]] = -2
        hits += len(found[ids[at]] & set(ids[np.lexsort((ids, -cosines))[:5]].tolist()))
    assert set(found) == set(ids[ids % 50 == 0].tolist()) and hits >= 0.9 * 5 * len(found)
