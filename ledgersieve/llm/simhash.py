"""Near duplicates by SimHash: vantage-point trees over fingerprints, and connected components.

Equal fingerprints are one class, so exact copies cost one row. A vantage-point tree over the
classes splits them by Hamming distance from a pivot. The ball keeps distances up to its radius,
the rest keeps distances above the radius less the link distance: by the triangle inequality any
two linked fingerprints are together on at least one side, so every leaf can be searched alone and
no link is lost. Fingerprints near a boundary go to both sides. The upper tree comes from a bounded
sample and spreads fingerprints over shards; each shard goes on splitting in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .texts import slices, stored

_BRUTE_ROWS = 768
_ROW_BLOCK = 64


def text_fingerprint(text: str | None, shingle_words: int) -> int:
    """The SimHash of one text: a bit is set if over half of the shingles' XXH64 (seed 42) have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle_words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(words[i : i + shingle_words]), 42) for i in range(count)], dtype="<u8")
    ones = np.unpackbits(hashes.view("u1").reshape(count, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text) and the fingerprint (long) of the whole text, lower-cased in A-Z.

    A text without words has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                found = np.array([text_fingerprint(t, shingle_words) for t in rows.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("text_hash"), pa.array(found.view(np.int64))],
                    ["doc_id", "text_hash", "fingerprint"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, max_bits: int = 3, shard_rows: int = 32_768, sample_rows: int = 32_768
) -> DataFrame:
    """Components of documents whose fingerprints differ in ``max_bits`` bits or fewer.

    Returns doc_id, text_hash (xxhash64 of the text), fingerprint (long), component_id: the smallest
    doc_id that links reach, its own included, and root: a fingerprint that names the component where
    doc_ids repeat. Further columns of ``docs`` are ignored. Null and empty texts share fingerprint 0,
    which links as any other. Null doc_ids are linked but name no component unless all are null.
    Repeated rows come back as often as they are given. ``sample_rows`` bounds the sample behind the
    upper tree, which only spreads work: every fingerprint is searched.
    """
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    classes = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "classes"
    )
    roots = components(_links(classes.select("fingerprint"), max_bits, shard_rows, sample_rows))
    rooted = (
        classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .filter("copies > 1 OR root IS NOT NULL")
        .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(names, "root").select("fingerprint", "component_id", "root")
    return prints.join(groups, "fingerprint", "left").select(
        "doc_id", "text_hash", "fingerprint", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("root", "fingerprint").alias("root"),
    )


def _links(prints: DataFrame, max_bits: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """Links between different fingerprints, enough to connect all that are near: node, other."""
    count = prints.count()
    tree: dict[int, tuple[int, int, int, int]] = {}
    if count > shard_rows:
        part = min(0.5, sample_rows / count)
        sampled = prints.filter(F.expr(f"pmod(xxhash64(fingerprint, 7), 1000000) < {int(part * 1e6)}"))
        sample = sampled.toPandas()["fingerprint"].to_numpy(np.int64).view(np.uint64)
        tree = _upper_tree(sample, count / max(1, len(sample)), max_bits, shard_rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            waiting = [(0, values)]
            while waiting:
                node, held = waiting.pop()
                if not len(held):
                    continue
                if node not in tree:
                    shard = np.full(len(held), node, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(held.view(np.int64))], ["shard", "fingerprint"])
                    continue
                pivot, radius, ball, rest = tree[node]
                away = np.bitwise_count(held ^ np.uint64(pivot)).astype(np.int16)
                waiting += [(ball, held[away <= radius]), (rest, held[away > radius - max_bits])]

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        held = rows["fingerprint"].to_numpy(np.int64)
        labels = near_labels(held.view(np.uint64), max_bits)
        linked = labels != np.arange(len(held))
        return pd.DataFrame({"node": held[linked], "other": held[labels[linked]]})

    routed = prints.mapInArrow(route, "shard long, fingerprint long")
    return routed.groupBy("shard").applyInPandas(search, "node long, other long")


def _upper_tree(sample: np.ndarray, weight: float, max_bits: int, shard_rows: int) -> dict[int, tuple[int, int, int, int]]:
    """Inner nodes by number: pivot, radius, numbers of the ball's node and the other. A shard is a number that is no inner node."""
    tree: dict[int, tuple[int, int, int, int]] = {}
    waiting, used = [(0, sample)], 0
    while waiting:
        node, held = waiting.pop()
        if len(held) * weight <= shard_rows or len(held) < 16:
            continue
        split = _split(held, max_bits)
        if split is None:
            continue
        pivot, radius, away = split
        tree[node] = (int(pivot), radius, used + 1, used + 2)
        waiting += [(used + 1, held[away <= radius]), (used + 2, held[away > radius - max_bits])]
        used += 2
    return tree


def _split(held: np.ndarray, max_bits: int) -> tuple[np.uint64, int, np.ndarray] | None:
    """Pivot, radius and distances for two sides of like size; None if one side would keep nearly all.

    Of a few pivots the one whose distances spread most: the fewer lie near its boundary.
    """
    pivots = held[np.linspace(0, len(held) - 1, 5).astype(int)]
    aways = [np.bitwise_count(held ^ pivot).astype(np.int16) for pivot in pivots]
    pivot, away = max(zip(pivots, aways, strict=True), key=lambda x: x[1].std())
    within = np.cumsum(np.bincount(away, minlength=65))
    radii = np.arange(65)
    ball, rest = within, len(held) - np.where(radii >= max_bits, within[np.maximum(radii - max_bits, 0)], 0)
    radius = int(np.argmin(np.maximum(ball, rest)))
    return (pivot, radius, away) if max(ball[radius], rest[radius]) <= 0.85 * len(held) else None


def near_labels(held: np.ndarray, max_bits: int) -> np.ndarray:
    """For different fingerprints, the place of the first one in each one's connected component."""
    labels = np.arange(len(held))
    waiting = [labels]
    while waiting:
        places = waiting.pop()
        values = held[places]
        split = _split(values, max_bits) if len(values) > _BRUTE_ROWS else None
        if split is not None:
            _, radius, away = split
            waiting += [places[away <= radius], places[away > radius - max_bits]]
            continue
        for start in range(0, len(values), _ROW_BLOCK):
            block = values[start : start + _ROW_BLOCK]
            near = np.bitwise_count(block[:, None] ^ values[None, start:]) <= max_bits
            one, other = np.nonzero(near)
            ahead = other > one
            labels = _merge(labels, places[start + one[ahead]], places[start + other[ahead]])
    return labels


def _merge(labels: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Labels after linking pairs of places; a label is the first place of a component."""
    while True:
        left, right = labels[one], labels[other]
        apart = left != right
        if not apart.any():
            return labels
        one, other, left, right = one[apart], other[apart], left[apart], right[apart]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(labels, up := labels[labels]):
            labels = up


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node and root (the smallest node) of each connected component of links (node, other).

    Alternates two steps until nothing changes: every node hangs its larger neighbours on its
    smallest neighbour, then its smaller ones. The rounds grow with the logarithm of the longest
    chain; each is written to the shared folder. A hub is aggregated before it is joined.
    """
    links = stored(links.filter("node <> other").selectExpr("greatest(node, other) AS node", "least(node, other) AS other").distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = links.unionByName(links.selectExpr("other AS node", "node AS other"))
        least = both.groupBy("node").agg(F.min("other").alias("low")).selectExpr("node", "least(node, low) AS low")
        large = both.join(least, "node").filter("other > node").selectExpr("other AS node", "low AS other").distinct()
        lower = large.groupBy("node").agg(F.min("other").alias("low"))
        small = (
            large.join(lower, "node")
            .selectExpr("inline(array(struct(other AS node, low AS other), struct(node AS node, low AS other)))")
            .filter("node <> other")
            .distinct()
        )
        links = stored(small, "links")
        after = links.agg(F.count("*"), F.expr("sum(CAST(xxhash64(node, other) AS DECIMAL(38, 0)))")).first()
        if after == before:
            return links.selectExpr("node", "other AS root").unionByName(
                links.selectExpr("other AS node", "other AS root").distinct()
            )
        before = after
    raise RuntimeError(f"components are not settled after {most_rounds} rounds")
