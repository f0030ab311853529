"""Approximate nearest neighbours by cosine: inverted lists and an adaptive scan of dimensions.

Unit vectors are turned by a random rotation, so that any few of their components are a fair sample
of all. A list keeps them in column blocks. A scan adds up squared distances block by block; after
each one, a candidate whose partial distance is so large that its whole distance is unlikely to be
below the best so far (a test at a fixed confidence) is given up. What is left is measured exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame, functions as F

from .texts import stored
from .vectors import best, matrix, usable

_CHUNK = 512


@dataclass
class Lists:
    """Where the lists lie: unit centres and a rotation; both are bounded in size."""

    centres: np.ndarray
    rotation: np.ndarray

    @property
    def dims(self) -> int:
        return self.centres.shape[1]


def fit_lists(sample: np.ndarray, lists: int, seed: int = 5, rounds: int = 12) -> Lists:
    """Spherical k-means over a sample, and a random rotation."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0] if dims else np.zeros((0, 0))
    unit = _unit(sample)
    centres = unit[rng.choice(len(unit), min(lists, len(unit)), replace=False)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        moved = lengths > 0
        centres[moved] = sums[moved] / lengths[moved, None]
    return Lists(centres, rotation)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of tiny or huge components stay in range
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class ListBlock:
    """Some vectors of one list: rotated unit vectors in column blocks, and the originals."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rotation: np.ndarray, columns: int = 16):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        turned = _unit(self.vectors) @ rotation
        self.cuts = [*range(0, turned.shape[1], columns), turned.shape[1]]
        self.blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        self.scale = np.abs(self.vectors).max(axis=1)
        scaled = self.vectors / self.scale[:, None]
        self.lengths = np.sqrt((scaled * scaled).sum(axis=1))
        self.scaled = scaled
        self.read = 0

    def search(self, query: np.ndarray, turned: np.ndarray, query_id: int, k: int, confidence: float) -> list[tuple[float, int]]:
        """The k largest cosines found as (score, id); rows with the query's id are left out."""
        dims, bound = self.cuts[-1], np.inf
        scaled = query / np.abs(query).max()
        length = sqrt(float((scaled * scaled).sum()))
        found: list[tuple[float, int]] = []
        for start in range(0, len(self.ids), _CHUNK):
            alive = np.arange(start, min(start + _CHUNK, len(self.ids)))
            partial = np.zeros(len(alive))
            for block, begin, end in zip(self.blocks, self.cuts, self.cuts[1:], strict=False):
                gap = block[alive] - turned[begin:end]
                partial += (gap * gap).sum(axis=1)
                self.read += gap.size
                if bound < np.inf and end < dims:
                    stays = partial * (dims / end) <= bound * (1.0 + confidence / sqrt(end)) ** 2
                    alive, partial = alive[stays], partial[stays]
                    if not len(alive):
                        break
            alive = alive[(partial <= bound) & (self.ids[alive] != query_id)]
            if not len(alive):
                continue
            scores = (self.scaled[alive] * scaled).sum(axis=1) / (self.lengths[alive] * length)
            top = np.lexsort((self.ids[alive], -scores))[:k]
            found = sorted([*found, *zip(scores[top].tolist(), self.ids[alive[top]].tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
            if len(found) == k:
                bound = max(0.0, 2.0 - 2.0 * found[-1][0]) + 1e-9
        return found


def nearest_by_cosine(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    probed_share: float = 0.7,
    most_lists: int = 512,
    sample_rows: int = 20_000,
    block_rows: int = 8_192,
    query_rows: int = 20_000,
    confidence: float = 2.1,
) -> DataFrame:
    """For rows whose vec_id is divisible by ``every``, the k nearest other rows found.

    ``vectors`` has vec_id (long) and embedding (array of numbers). Returns query_id, rank (from 1),
    vec_id, score (the cosine of the original vectors in double precision), ties to the smaller
    vec_id. Each query reads the nearest ``probed_share`` of all lists, and more if those hold too
    few candidates. Further columns are ignored.

    Null vec_ids and vectors that are null, zero or hold null or non-finite components take no part.
    Rows equal in vec_id and components count once; rows that share only the vec_id are candidates
    for all queries but those of that vec_id. Shorter vectors count as ending in zeros.

    Centres are fitted on at most about ``sample_rows`` rows; every row is indexed. A list longer
    than ``block_rows`` is dealt over blocks by hash, so copies of one vector spread evenly.
    """
    used = vectors.filter(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull() & F.exists("embedding", lambda x: x != 0)
    ).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    used = used.distinct().withColumn("draw", F.xxhash64("vec_id", "v"))
    shape = used.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    if not shape["n"]:
        return used.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "1D AS score").filter("false")
    rows, dims = shape["n"], shape["dims"]
    lists = min(most_lists, max(1, rows // 20))
    sampled = used.filter(F.pmod("draw", F.lit(1_000_000)) < max(1, ceil(min(1.0, sample_rows / rows) * 1e6)))
    sample = matrix(sampled.select("v").toArrow()["v"], dims)
    if not len(sample):  # a few rows, none of which the hash picks
        sample = matrix(used.select("v").limit(lists).toArrow()["v"], dims)
    model = fit_lists(sample, lists)
    lists = len(model.centres)
    probes = max(1, ceil(probed_share * lists))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = (_unit(matrix(batch.column("v"), dims)) @ model.centres.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32))], [*batch.schema.names, "list"])

    listed = stored(used.mapInArrow(assign, "vec_id long, v array<double>, draw long, list int"), "lists")
    sizes = np.zeros(lists, dtype=np.int64)
    for row in listed.groupBy("list").count().collect():  # one row per list, so bounded
        sizes[row["list"]] = row["count"]
    blocks = np.maximum(1, -(-sizes // block_rows))
    wanted = listed.filter(F.col("vec_id") % every == 0)
    parts = max(1, ceil(wanted.count() * probed_share / query_rows))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(-(_unit(matrix(batch.column("v"), dims)) @ model.centres.T), axis=1, kind="stable")
            enough = np.cumsum(sizes[order], axis=1) > k
            counts = np.maximum(probes, enough.argmax(axis=1) + 1)
            counts[~enough[:, -1]] = lists
            query = np.repeat(np.arange(len(counts)), counts)
            chosen = np.concatenate([o[:c] for o, c in zip(order, counts, strict=True)]) if len(counts) else np.zeros(0, int)
            times = blocks[chosen]
            query, chosen = np.repeat(query, times), np.repeat(chosen, times)
            block = np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, int)
            for at in range(0, len(query), 20_000):
                span = slice(at, at + 20_000)
                taken = batch.select(["vec_id", "v", "draw"]).take(pa.array(query[span]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chosen[span].astype(np.int32)), pa.array(block[span].astype(np.int32)),
                        pa.array(np.asarray(taken.column("draw")) % parts, pa.int32()),
                        taken.column("vec_id"), taken.column("v"), taken.column("draw"),
                    ],
                    ["list", "block", "part", "query_id", "v", "draw"],
                )

    per_list = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("list") + 1)
    left = listed.select(
        "list", F.pmod("draw", per_list).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "vec_id", "v",
    )
    right = wanted.select("vec_id", "v", "draw").mapInArrow(
        probe, "list int, block int, part int, query_id long, v array<double>, draw long"
    )

    def scan(held: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if len(held) and len(queries):
            block = ListBlock(matrix(held["v"], dims), held["vec_id"].to_numpy(), model.rotation)
            plain = matrix(queries["v"], dims)
            for query, turned, name, draw in zip(
                plain, _unit(plain) @ model.rotation, queries["query_id"].to_pylist(), queries["draw"].to_pylist(), strict=True
            ):
                out += [(name, draw, other, score) for score, other in block.search(query, turned, name, k, confidence)]
        names, draws, others, scores = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table(
            [pa.array(names, pa.int64()), pa.array(draws, pa.int64()), pa.array(others, pa.int64()), pa.array(scores, pa.float64())],
            ["query_id", "draw", "vec_id", "score"],
        )

    keys = ["list", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, "query_id long, draw long, vec_id long, score double")
    return best(found, ["query_id", "draw"], k)
