"""Hard negatives by threshold joins over an inverted index with norm bounds.

The index has a list for every group of components, weak groups first, with the rows that hold it, long rows
in front. For a threshold the tail of a list is left out: there the prefixes (the components up to the group's
end) of row and query are so short that by the Cauchy-Schwarz inequality their product stays below it. What
the lists hold is added up from the strongest group on; a pair ends when its sum and the norms of what is
left cannot reach the threshold. Thresholds start high and are lowered until enough rows are found.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .texts import stored
from .vectors import matrix, usable

_ANCHORS, _GROUP = 64, 8
_SLACK = 1e-9
#: Shares of the highest possible score that a search for positives falls back to, one after the other.
_LEVELS = (0.8, 0.6, 0.45, 0.3, 0.15, 0.0)
_WINDOW_LEVELS = 4


class NormIndex:
    """Rows of integers to be joined with queries at thresholds of the inner product."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(np.square(vectors.astype(np.float64)).sum(axis=0), kind="stable")
        points = vectors[:, self.order].astype(np.float64)
        self.rows = np.argsort(-np.square(points).sum(axis=1), kind="stable")
        self.vectors = vectors[self.rows]
        self.points = points[self.rows]
        self.norms = _prefix_norms(self.points)
        self.groups = [(at, min(at + _GROUP, vectors.shape[1])) for at in range(0, vectors.shape[1], _GROUP)]
        # Per group the longest prefix from a row on: where it falls below a bound, the list ends.
        self.longest = [np.maximum.accumulate(self.norms[::-1, end])[::-1] for _, end in self.groups]
        self.added = 0  # products of components, for a comparison with all of them

    def join(self, queries: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (place of the query, row, score) that are allowed and whose score is at least the query's threshold."""
        points = queries[:, self.order].astype(np.float64)
        norms = _prefix_norms(points)
        goal = least[:, None] - _SLACK
        spare = 1 + _SLACK
        sums = np.zeros(allowed.shape)
        alive = allowed[:, self.rows] & (norms[:, -1:] * self.norms[:, -1] * spare >= goal)
        # Rounding errors are far below this share of the longest product.
        goal = goal - _SLACK * norms[:, -1:] * self.norms[:, -1].max(initial=0.0)
        held = len(self.rows)
        for (start, end), longest in zip(reversed(self.groups), reversed(self.longest), strict=True):
            with np.errstate(divide="ignore", invalid="ignore"):
                # Not below this norm can a prefix reach a threshold; all can where that is 0 or less.
                needed = np.where(least <= 0, 0.0, least / norms[:, end])
            cut = float(np.nanmin(needed, initial=np.inf)) * (1 - 1e-6)
            listed = min(held, len(longest) - int(np.searchsorted(longest[::-1], cut, side="left")))
            if listed < held:
                alive[:, listed:held] &= sums[:, listed:held] + norms[:, end, None] * self.norms[listed:held, end] >= goal
                held = listed
            if not held:
                break
            sums[:, :held] += points[:, start:end] @ self.points[:held, start:end].T
            self.added += held * (end - start) * len(points)
            alive[:, :held] &= sums[:, :held] + norms[:, start, None] * self.norms[:held, start] >= goal
            if np.count_nonzero(alive) <= alive.size // 64:
                break
        query, row = np.nonzero(alive)
        scores = self._exact(queries, query, row)
        good = np.asarray(scores >= least[query], dtype=bool)
        return query[good], self.rows[row[good]], scores[good]

    def _exact(self, queries: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
        highest = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * queries.shape[1]
        if highest < 2**62:
            return np.einsum("ij,ij->i", queries[query], self.vectors[row])
        return (queries[query].astype(object) * self.vectors[row].astype(object)).sum(axis=1)


def _prefix_norms(points: np.ndarray) -> np.ndarray:
    """The norm of the first 0, 1, 2 ... components of each row."""
    squares = np.cumsum(np.square(points), axis=1)
    return np.sqrt(np.concatenate([np.zeros((len(points), 1)), squares], axis=1))


def top_of_label(index: NormIndex, ids: np.ndarray, labels: np.ndarray, queries, query_ids, query_labels, k: int):
    """For each query the k best rows of its label but those of its own id: places of queries, rows, scores."""
    open_places = np.arange(len(queries))
    highest = index.norms[:, -1].max(initial=0.0) * np.linalg.norm(queries.astype(np.float64), axis=1)
    for share in (*_LEVELS, None):
        least = np.full(len(open_places), -np.inf) if share is None else share * highest[open_places]
        allowed = (labels == query_labels[open_places, None]) & (ids != query_ids[open_places, None])
        query, row, score = index.join(queries[open_places], least, allowed)
        filled = np.bincount(query, minlength=len(open_places)) >= k if share is not None else np.ones(len(open_places), bool)
        for place in np.flatnonzero(filled).tolist():
            mine = np.flatnonzero(query == place)
            yield from _first(int(open_places[place]), row[mine], score[mine], ids, k)
        open_places = open_places[~filled]
        if not len(open_places):
            return


def top_of_windows(index: NormIndex, ids, labels, queries, query_ids, query_labels, highs: list[list[int]], low: int, k: int):
    """For each query and each of its windows from ``low`` percent of a score up to it, the k best rows of other labels.

    Gives place of the query, place of the window, row, score.
    """
    open_windows = {place: [(w, -(-low * high // 100), high) for w, high in enumerate(own) if low * high <= 100 * high] for place, own in enumerate(highs)}
    for level in range(1, _WINDOW_LEVELS + 1):
        places = [place for place, windows in open_windows.items() if windows]
        if not places:
            return
        reach = lambda floor, high: high - -(-(high - floor) * level // _WINDOW_LEVELS)
        least = np.array([min(reach(f, h) for _, f, h in open_windows[p]) for p in places], dtype=np.float64)
        at = np.array(places)
        allowed = (labels != query_labels[at, None]) & (ids != query_ids[at, None])
        query, row, score = index.join(queries[at], least, allowed)
        starts = np.searchsorted(query, np.arange(len(places) + 1))
        for number, place in enumerate(places):
            rows, scores = row[starts[number] : starts[number + 1]], score[starts[number] : starts[number + 1]]
            waiting = []
            for window, floor, high in open_windows[place]:
                inside = np.asarray((scores >= max(floor, reach(floor, high))) & (scores <= high), dtype=bool)
                if inside.sum() < k and level < _WINDOW_LEVELS:
                    waiting.append((window, floor, high))
                    continue
                for _, other, value in _first(place, rows[inside], scores[inside], ids, k):
                    yield place, window, other, value
            open_windows[place] = waiting


def _first(place: int, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    best = sorted(((-int(s), int(ids[r]), int(r)) for r, s in zip(rows, scores, strict=True)))[:k]
    return [(place, row, -score) for score, _, row in best]


def mine_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, scale: int = 256, low: int = 80,
    shard_rows: int = 8_192, anchor_rows: int = 4_096,
) -> DataFrame:
    """For rows whose vec_id is divisible by ``every`` (anchors): hard negatives for each of their positives.

    ``vectors`` has vec_id (long), label and embedding (array of numbers); a component x counts as
    floor(``scale`` * x), a score is an inner product. An anchor's positives are the rows of its label
    with the highest scores, at most ``positives``. A positive's negatives are the rows of other labels
    with the highest scores from ``low`` percent of the positive's score up to it, at most ``negatives``.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score (longs);
    ties go to the smaller vec_id. A positive without negatives has no row; one with a score below 0 has none.

    Null vec_ids, labels or vectors and vectors with null or non-finite components take no part. Equal rows
    count once; rows that share only the vec_id are anchors of their own, but nothing to each other. Shorter
    vectors end in zeros. Further columns are ignored. Scores must fit in 64 bits.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    used = stored(
        vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
        .distinct()
        .withColumn("draw", F.xxhash64("vec_id", "label", "v")),
        "labelled_vectors",
    )
    anchors = used.filter(F.col("vec_id") % every == 0)
    shards = max(1, ceil(used.count() / shard_rows))
    blocks = max(1, ceil(anchors.count() / anchor_rows))
    rows = used.select(
        F.pmod("draw", F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "vec_id", "label", "v",
    ).groupBy("shard", "block")

    def to_shards(queries: DataFrame):
        return queries.select(
            F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"), F.pmod("draw", F.lit(blocks)).cast("int").alias("block"), "*"
        ).groupBy("shard", "block")

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for index, ids, labels, queries, query_ids, query_labels, draws, _ in _blocks(left, right):
            for place, row, score in top_of_label(index, ids, labels, queries, query_ids, query_labels, positives):
                out.append((int(query_ids[place]), draws[place], int(ids[row]), score))
        return _longs(out, ["anchor_id", "draw", "positive_id", "positive_score"])

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for index, ids, labels, queries, query_ids, query_labels, draws, highs in _blocks(left, right):
            for place, window, row, score in top_of_windows(index, ids, labels, queries, query_ids, query_labels, highs, low, negatives):
                out.append((int(query_ids[place]), draws[place], window, int(ids[row]), score))
        return _longs(out, ["anchor_id", "draw", "place", "negative_id", "negative_score"])

    longs = lambda *names: ", ".join(f"{name} long" for name in names)
    near = rows.cogroup(to_shards(anchors)).applyInArrow(nearest, longs("anchor_id", "draw", "positive_id", "positive_score"))
    own = Window.partitionBy("anchor_id", "draw").orderBy(F.desc("positive_score"), "positive_id")
    chosen = stored(near.withColumn("place", F.row_number().over(own) - 1).filter(F.col("place") < positives), "positives")
    highs = chosen.groupBy("anchor_id", "draw").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    highs = highs.select(F.col("anchor_id").alias("vec_id"), "draw", F.col("p.positive_score").alias("highs"))
    wanted = stored(anchors.join(highs, ["vec_id", "draw"]), "windows")
    found = rows.cogroup(to_shards(wanted)).applyInArrow(windows, longs("anchor_id", "draw", "place", "negative_id", "negative_score"))
    window = Window.partitionBy("anchor_id", "draw", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "draw", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def _blocks(left: pa.Table, right: pa.Table):
    """The index of a shard with its ids and labels, for each small block of queries with theirs."""
    if not len(left) or not len(right):
        return
    dims = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (left, right))
    index = NormIndex(matrix(left["v"], dims, np.int64))
    ids, labels = left["vec_id"].to_numpy(), left["label"].to_numpy()
    queries = matrix(right["v"], dims, np.int64)
    query_ids, query_labels, draws = right["vec_id"].to_numpy(), right["label"].to_numpy(), right["draw"].to_pylist()
    highs = right["highs"].to_pylist() if "highs" in right.column_names else [[]] * len(right)
    for start in range(0, len(queries), _ANCHORS):
        part = slice(start, start + _ANCHORS)
        yield index, ids, labels, queries[part], query_ids[part], query_labels[part], draws[part], highs[part]


def _longs(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)
