"""Substring dedup: equal windows of words, dealt by prefixes of varying length.

Hashed windows of a fixed depth stand in for suffix trees: no suffixes are sorted, and no nodes of
other depths are made. Every word position starts a suffix. A suffix goes to the group of its shortest
prefix that few enough suffixes share: one word for rare words, more for common ones, up to the window.
A first pass counts suffixes by prefix in tables of fixed size and packs the groups into shards that fit
in memory. A shard groups its suffixes by the hash of their first ``window`` words; a group (called node,
its suffixes leaves) is all places of one repeated window. The first document of a node keeps it;
elsewhere the window's words go. Windows that follow one another join to longer runs.

Paths are compared by 64-bit fingerprints of their words, so that a suffix costs some ten bytes of
shuffle and not its words. Two different windows meet by chance once in 2**64 pairs of one shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .texts import slices

_LEVELS = (1, 2, 4)
_CELLS = 1 << 14
_SLICE_CHARS = 2_000_000
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD1342543DE82EF95)
_LINE = np.uint64(0xBF58476D1CE4E5B9)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: np.uint64, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    steps = np.full(count, base, dtype=np.uint64)
    back = np.full(count, np.uint64(pow(int(base), -1, 1 << 64)), dtype=np.uint64)
    if count:
        steps[0] = back[0] = 1
    return np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _LINE
    values = (values ^ (values >> np.uint64(29))) * _BYTE_BASE
    return values ^ (values >> np.uint64(32))


class WordLine:
    """The words of several texts in one line, with fingerprints of runs of words."""

    def __init__(self, texts: list[bytes]):
        line = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[line]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        starts, ends = edges[0::2], edges[1::2]
        power, inverse = _powers(_BYTE_BASE, len(line))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((line.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
        words = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _LINE)
        text_starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        #: First word of each text, and one past the last.
        self.bounds = np.searchsorted(starts, text_starts)
        self.count = len(words)
        power, self._inverse = _powers(_WORD_BASE, self.count + 1)
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(words * power[:-1], dtype=np.uint64)])

    def runs(self, length: int, starts: np.ndarray) -> np.ndarray:
        """Fingerprints of the runs of so many words at the given words."""
        return _mixed((self._sums[starts + length] - self._sums[starts]) * self._inverse[starts])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The words that start a run of so many words within one text, and the number of that text."""
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        starts = np.arange(self.count)
        whole = starts + length <= self.bounds[text + 1] if self.count else starts.astype(bool)
        return starts[whole], text[whole]


def _texts(rows: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [t or b"" for t in rows.column(column).cast(pa.binary()).to_pylist()]


def _cells(line: WordLine, starts: np.ndarray, window: int) -> list[np.ndarray]:
    """For each level, the cell of every suffix's prefix of that many words."""
    return [(line.runs(min(n, window), starts) >> np.uint64(50)).astype(np.int64) for n in _LEVELS]


class PrefixShards:
    """Which shard a suffix goes to: its prefix is lengthened while too many suffixes share it."""

    def __init__(self, counts: np.ndarray, shard_suffixes: int):
        """``counts``: suffixes per level and cell, fixed in size."""
        total = int(counts[0].sum())
        self.shards = max(1, ceil(total / shard_suffixes))
        #: A group much smaller than a shard can be packed with others; a larger one gets a longer prefix.
        self.small = counts <= max(1, shard_suffixes // 8)

    def of(self, line: WordLine, starts: np.ndarray, window: int) -> np.ndarray:
        prefix = line.runs(window, starts)
        open_ = np.ones(len(starts), dtype=bool)
        for level, (length, cells) in enumerate(zip(_LEVELS, _cells(line, starts, window), strict=True)):
            fits = open_ & self.small[level][cells]
            prefix[fits] = line.runs(min(length, window), starts[fits])
            open_ &= ~fits
        return (_mixed(prefix) % np.uint64(self.shards)).astype(np.int64)


def _prefix_counts(docs: DataFrame, window: int) -> np.ndarray:
    """Suffixes per level and cell: one table of fixed size per task, added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(_LEVELS), _CELLS), dtype=np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                line = WordLine(_texts(rows))
                for level, cells in enumerate(_cells(line, line.windows(window)[0], window)):
                    table[level] += np.bincount(cells, minlength=_CELLS)
        flat = table.ravel()
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["cell", "n"])

    found = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(len(_LEVELS) * _CELLS, dtype=np.int64)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(len(_LEVELS), _CELLS)


def repeated_windows(docs: DataFrame, window: int = 13, shard_suffixes: int = 1_500_000) -> DataFrame:
    """Where windows of words start that also start in a document with a smaller doc_id.

    doc_id, text_hash (xxhash64 of the text; tells rows with one doc_id apart), places (binary:
    ascending 32-bit word numbers). Windows do not cross documents.
    """
    shards = PrefixShards(_prefix_counts(docs, window), shard_suffixes)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text", _SLICE_CHARS):
                yield from _suffix_rows(rows, part << 32 | number, shards, window)
                number += 1

    packed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        suffixes, "shard long, slice long, ids binary, suffixes binary, keys binary, settled binary"
    )
    leaves = packed.groupBy("shard").applyInArrow(_leaves_to_cut, "slice long, keys binary, leaves binary")
    return leaves.groupBy("slice").applyInArrow(_by_document, "doc_id long, text_hash long, places binary")


def _suffix_rows(rows: pa.RecordBatch, number: int, shards: PrefixShards, window: int) -> Iterator[pa.RecordBatch]:
    """A slice of documents as one packed row per shard; the first one also names the documents.

    Among the documents of the slice, all but the first to have a window are settled here, so that a
    passage copied many times sends few suffixes to its shard.
    """
    line = WordLine(_texts(rows))
    starts, text = line.windows(window)
    if not len(starts):
        return
    ids = rows.column("doc_id").fill_null(0).to_numpy()
    named = rows.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    rank = _id_ranks(ids, named)
    keys = zlib.compress(np.stack([ids, named.astype(np.int64), rows.column("text_hash").to_numpy(), line.bounds[:-1]]).tobytes(), 1)

    paths = line.runs(window, starts)
    by_path = np.argsort(paths, kind="stable")
    node = np.cumsum(np.concatenate([[True], paths[by_path][1:] != paths[by_path][:-1]])) - 1
    lowest = np.full(node[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, node, rank[text[by_path]])
    goes = np.empty(len(starts), dtype=bool)
    goes[by_path] = rank[text[by_path]] > lowest[node]
    settled = _pack_steps(starts[goes])

    starts, text, paths = starts[~goes], text[~goes], paths[~goes]
    shard = shards.of(line, starts, window)
    order = np.argsort(shard, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        texts, first = np.unique(text[part], return_index=True)
        owners = np.stack([ids[texts], named[texts].astype(np.int64), first])
        own_ids = zlib.compress(np.diff(owners, prepend=0, axis=1).astype("<i8").T.tobytes(), 1)
        data = len(part).to_bytes(4, "little") + paths[part].astype("<u8").tobytes() + _pack_steps(starts[part])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(shard[part[0]])], pa.int64()), pa.array([number], pa.int64()), pa.array([own_ids], pa.binary()),
                pa.array([data], pa.binary()), pa.array([keys], pa.binary()), pa.array([settled], pa.binary()),
            ],
            ["shard", "slice", "ids", "suffixes", "keys", "settled"],
        )
        keys = settled = None


def _pack_steps(ascending: np.ndarray) -> bytes:
    """Ascending numbers as deflated differences, low bytes first."""
    steps = np.diff(ascending.astype(np.int64), prepend=0).astype("<u4")
    return zlib.compress(steps.view("u1").reshape(-1, 4).T.tobytes(), 1)


def _unpack_steps(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), "u1").reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def _leaves_to_cut(rows: pa.Table) -> pa.Table:
    """The leaves below a shard's internal nodes, but those of each node's first document, by slice."""
    ids, named, paths, owner, starts, sizes, known = [], [], [], [], [], [], 0
    for head, data in zip(rows["ids"].to_pylist(), rows["suffixes"].to_pylist(), strict=True):
        own_ids, own_named, first = np.cumsum(np.frombuffer(zlib.decompress(head), "<i8").reshape(-1, 3), axis=0).T
        size = int.from_bytes(data[:4], "little")
        ids.append(own_ids)
        named.append(own_named == 1)
        paths.append(np.frombuffer(data, "<u8", size, 4))
        starts.append(_unpack_steps(data[4 + 8 * size :]).astype(np.uint32))
        owner.append(np.repeat(np.arange(known, known + len(first), dtype=np.uint32), np.diff(np.append(first, size))))
        sizes.append(size)
        known += len(first)
    rank = _id_ranks(np.concatenate(ids), np.concatenate(named))[np.concatenate(owner)]
    del ids, named, owner
    paths, starts = np.concatenate(paths), np.concatenate(starts)
    by_path = np.argsort(paths, kind="stable")
    paths = paths[by_path]
    new_node = np.concatenate([[True], paths[1:] != paths[:-1]])
    first = np.minimum.reduceat(rank[by_path], np.flatnonzero(new_node))
    cut = np.empty(len(paths), dtype=bool)
    cut[by_path] = rank[by_path] > first[np.cumsum(new_node) - 1]
    ends = np.cumsum(sizes)
    leaves = [
        zlib.compress(b"") if not cut[end - size : end].any() else _pack_steps(starts[end - size : end][cut[end - size : end]])
        for end, size in zip(ends.tolist(), sizes, strict=True)
    ]
    found = pa.table({"slice": rows["slice"], "keys": rows["keys"], "leaves": pa.array(leaves, pa.binary())})
    settled = rows.filter(rows["settled"].is_valid())
    nameless = pa.nulls(len(settled), pa.binary())
    return pa.concat_tables([found, pa.table({"slice": settled["slice"], "keys": nameless, "leaves": settled["settled"]})])


def _by_document(rows: pa.Table) -> pa.Table:
    """A slice's leaves as places within its documents."""
    keys = next(k for k in rows["keys"].to_pylist() if k is not None)
    ids, named, hashes, bounds = np.frombuffer(zlib.decompress(keys), "<i8").reshape(4, -1)
    starts = np.sort(np.concatenate([_unpack_steps(leaves) for leaves in rows["leaves"].to_pylist()]))
    text = np.searchsorted(bounds, starts, side="right") - 1
    texts, begins = np.unique(text, return_index=True)
    places = np.split((starts - bounds[text]).astype("<u4"), begins[1:]) if len(texts) else []
    return pa.table(
        {
            "doc_id": pa.array(ids[texts], pa.int64(), mask=named[texts] == 0),
            "text_hash": pa.array(hashes[texts], pa.int64()),
            "places": pa.array([p.tobytes() for p in places], pa.binary()),
        }
    )


def _id_ranks(ids: np.ndarray, named: np.ndarray) -> np.ndarray:
    """The rank of each document by doc_id, null last; equal ids share one."""
    order = np.lexsort((ids, ~named))
    fresh = (ids[order][1:] != ids[order][:-1]) | (named[order][1:] != named[order][:-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], fresh])) - 1
    return rank


def cut_repeats(docs: DataFrame, window: int = 13, shard_suffixes: int = 1_500_000) -> DataFrame:
    """All rows of ``docs`` with the words gone that a repeated window covers.

    Adds n_words, n_removed, kept (the words left, joined by one space) and spans (the maximal
    runs of words removed: array of structs start, end) to all columns given; ``docs`` needs doc_id
    and text and none of the added names (such a column is replaced).

    Words are runs of anything but ASCII white space, unchanged. A null text has none. A document
    keeps a window unless a document with a smaller doc_id has it; rows with equal doc_ids count as
    one document there and keep theirs; null doc_ids come after all others. What is repeated is
    judged on the input alone. Null, empty and short texts come back whole.
    """
    docs = docs.drop("n_words", "n_removed", "kept", "spans")
    found = (
        repeated_windows(docs, window, shard_suffixes)
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
        .groupBy("_id", "_hash")
        .agg(F.collect_list("places").alias("_places"))
    )
    # Columns by number, so that no name of the caller's meets one of these.
    names, numbers = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = numbers[names.index("doc_id")], numbers[names.index("text")]
    keyed = docs.toDF(*numbers).withColumn("_key", F.xxhash64(text))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    joined = keyed.join(found, same, "left").select(*numbers, "_places")
    added = "n_words long, n_removed long, kept string, spans array<struct<start: int, end: int>>"
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for rows in slices(batch, text):
                done = [
                    _cut_text(words, places, window)
                    for words, places in zip(_texts(rows, text), rows.column("_places").to_pylist(), strict=True)
                ]
                counts, removed, kept, spans = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(c) for c in numbers], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                        pa.array(kept, pa.string()), pa.array(spans, spans_kind),
                    ],
                    [*names, "n_words", "n_removed", "kept", "spans"],
                )

    return joined.mapInArrow(cut, f"{given}, {added}")


def _cut_text(text: bytes, places: list[bytes] | None, window: int) -> tuple[int, int, str, list[dict[str, int]]]:
    words = text.split()
    if not places:
        return len(words), 0, b" ".join(words).decode(), []
    starts = np.unique(np.concatenate([np.frombuffer(p, "<u4") for p in places])).astype(np.int64)
    breaks = np.flatnonzero(np.diff(starts) > window)
    begins, ends = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [-1]])] + window
    kept, at = [], 0
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        kept += words[at:begin]
        at = end
    kept += words[at:]
    spans = [{"start": b, "end": e} for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
    return len(words), len(words) - len(kept), b" ".join(kept).decode(), spans


def kept_digests(cut: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of what ``cut_repeats`` returns."""
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
