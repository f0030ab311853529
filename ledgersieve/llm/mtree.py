"""Exact top-k search by inner product with an M-tree, best pages first.

Adding one component that lifts all vectors to one length turns the largest inner product into the
nearest point, so metric bounds hold. Vectors are dealt over shards by hash; each shard builds an
M-tree whose pages keep, for every entry, its covering radius and its distance to the page's router.
A search opens pages in the order of their least possible distance. Before any distance is computed,
the triangle inequality over the stored distances leaves out entries that cannot be near enough.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .texts import stored
from .vectors import best, matrix, usable

_EXACT = float(1 << 52)


@dataclass
class _Page:
    """Entries of a page: rows of points, and for inner pages also child pages and covering radii."""

    rows: np.ndarray
    to_router: np.ndarray
    radii: np.ndarray | None = None
    children: list[_Page] = field(default_factory=list)


class MTree:
    """Whole-number vectors by distance, for the largest inner products with a query."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, page_rows: int = 256, fanout: int = 16):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.exact = self._exact(self.vectors)
        points = self.vectors.astype(np.float64)
        squares = (points * points).sum(axis=1)
        self.length = float(squares.max(initial=0.0))
        self.points = np.column_stack([points, np.sqrt(np.maximum(self.length - squares, 0.0))])
        self.page_rows, self.fanout = page_rows, fanout
        self.distances = 0
        rows = np.arange(len(ids))
        self.root = self._page(rows, np.zeros(len(rows)), np.random.default_rng(7)) if len(rows) else None

    @staticmethod
    def _exact(vectors: np.ndarray) -> bool:
        top = float(np.abs(vectors.astype(np.float64)).max(initial=0.0))
        return top * top * max(1, vectors.shape[1]) < _EXACT

    def _page(self, rows: np.ndarray, to_router: np.ndarray, rng: np.random.Generator) -> _Page:
        if len(rows) <= self.page_rows:
            return _Page(rows, to_router)
        routers = rows[rng.choice(len(rows), self.fanout, replace=False)]
        away = np.stack([self._between(rows, router) for router in routers])
        nearest = away.argmin(axis=0)
        groups = [np.flatnonzero(nearest == i) for i in range(self.fanout)]
        if max(map(len, groups)) > 0.95 * len(rows):  # copies of one point, or nearly: any split is as good
            groups = np.array_split(np.argsort(away[0], kind="stable"), self.fanout)
            nearest = np.zeros(len(rows), dtype=int)
            for i, group in enumerate(groups):
                nearest[group] = i
        held = [(i, group) for i, group in enumerate(groups) if len(group)]
        place_of = {row: place for place, row in enumerate(rows.tolist())}
        return _Page(
            rows=np.array([routers[i] for i, _ in held]),
            to_router=np.array([to_router[place_of[int(routers[i])]] for i, _ in held]),
            radii=np.array([away[i, group].max() for i, group in held]),
            children=[self._page(rows[group], away[i, group], rng) for i, group in held],
        )

    def _between(self, rows: np.ndarray, router: int) -> np.ndarray:
        gap = self.points[rows] - self.points[router]
        return np.sqrt((gap * gap).sum(axis=1))

    def search(self, query: np.ndarray, query_id: int, k: int) -> list[tuple[int, int]]:
        """The k largest inner products as (score, id), ties to the smaller id; rows with the query's id are left out."""
        if self.root is None:
            return []
        point = np.append(query.astype(np.float64), 0.0)
        square = float((point * point).sum())
        slack = 1e-7 * (1.0 + np.sqrt(square) + np.sqrt(self.length))
        exact = self.exact and self._exact(query[None, :]) and np.sqrt(square * self.length) < _EXACT
        found: list[tuple[int, int]] = []  # a heap with the worst in front: score, then -id
        bound = np.inf
        waiting = [(0.0, 0, self.root, None)]
        opened = 0
        while waiting:
            least, _, page, to_query = heapq.heappop(waiting)
            if least > bound:
                break
            if to_query is None:
                near = np.arange(len(page.rows))
            else:
                gap = np.abs(page.to_router - to_query)
                near = np.flatnonzero((gap if page.radii is None else gap - page.radii) <= bound)
            if not len(near):
                continue
            rows = page.rows[near]
            self.distances += len(rows)
            scores = self.points[rows] @ point
            if page.radii is not None:
                away = np.sqrt(np.maximum(square + self.length - 2.0 * scores, 0.0))
                for at, distance, lower in zip(near.tolist(), away.tolist(), (away - page.radii[near]).tolist(), strict=True):
                    if lower <= bound:
                        opened += 1
                        heapq.heappush(waiting, (max(lower, least), opened, page.children[at], distance))
                continue
            if exact:
                exact_scores = scores
            else:
                exact_scores = self.vectors[rows].astype(object) @ query.astype(object)
            good = self.ids[rows] != query_id
            if len(found) == k:
                good &= np.asarray(exact_scores >= found[0][0], dtype=bool)
            candidates = sorted(
                ((int(score), -int(other)) for score, other in zip(exact_scores[good], self.ids[rows[good]], strict=True)),
                reverse=True,
            )[:k]
            for candidate in candidates:
                if len(found) < k:
                    heapq.heappush(found, candidate)
                elif candidate > found[0]:
                    heapq.heapreplace(found, candidate)
            if len(found) == k:
                bound = float(np.sqrt(max(square + self.length - 2.0 * found[0][0], 0.0))) + slack
        return [(score, -other) for score, other in sorted(found, reverse=True)]


def top_inner_products(
    vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, shard_rows: int = 16_384, query_rows: int = 8_192
) -> DataFrame:
    """For rows whose vec_id is divisible by ``every``, the k other rows with the highest inner products.

    ``vectors`` has vec_id (long) and embedding (array of numbers); a component x counts as
    floor(``scale`` * x). Returns query_id, rank (from 1), vec_id, score (long), ties to the smaller
    vec_id; all candidates if there are fewer than k. Further columns are ignored.

    Null vec_ids, null vectors and vectors with null or non-finite components take no part. Rows
    equal in vec_id and components count once; rows that share only the vec_id are candidates for
    all queries but those of that vec_id, and each is a query of its own. Of vectors of unequal
    length the shorter counts as ending in zeros. Scores must fit in 64 bits.

    Every query meets every shard: blocks of at most about ``query_rows`` queries and ``shard_rows``
    vectors, dealt by hash, so that copies of one vector spread evenly.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    used = stored(
        vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
        .distinct()
        .withColumn("draw", F.xxhash64("vec_id", "v")),
        "vectors",
    )
    wanted = used.filter(F.col("vec_id") % every == 0)
    shards = max(1, ceil(used.count() / shard_rows))
    blocks = max(1, ceil(wanted.count() / query_rows))
    left = used.select(
        F.pmod("draw", F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v",
    )
    right = wanted.select(
        F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
        F.pmod("draw", F.lit(blocks)).cast("int").alias("block"), F.col("vec_id").alias("query_id"), "draw", "v",
    )

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        dims = max([0, *(int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in (rows["v"], queries["v"]) if len(c))])
        tree = MTree(matrix(rows["v"], dims, np.int64), rows["vec_id"].to_numpy(), 256) if len(rows) else None
        out: list[tuple[int, int, int, int]] = []
        if tree is not None and len(queries):
            names, draws = queries["query_id"].to_pylist(), queries["draw"].to_pylist()
            for query, name, draw in zip(matrix(queries["v"], dims, np.int64), names, draws, strict=True):
                out += [(name, draw, other, score) for score, other in tree.search(query, name, k)]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "draw", "vec_id", "score"])

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, draw long, vec_id long, score long")
    )
    return best(found, ["query_id", "draw"], k)
