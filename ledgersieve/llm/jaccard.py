"""Near copies by the Jaccard similarity of word shingles: a blocked sparse matrix product.

The matrix has a row per document and a column per shingle; a product of two rows is their overlap.
Three bounds keep the product small without losing a pair:

* A shingle that only one document has adds to no overlap, so its column is left out.
* Two linked rows of sizes m <= n share at least ``least`` * n shingles. With every row's shingles in one
  order, rare ones first, they share one of the first n - least * n + 1 (the prefix). Rows whose prefix
  holds no shared shingle end here, which are nearly all that have no near copy.
* Rows are cut into blocks that no link leaves: rows that share a prefix shingle, directly or over
  others. Within a block a row meets only rows of a size between ``least`` * n and n / ``least``, and
  rows that are known to be connected need no further product between them.

A block gives out a link per row, not one per pair. Shingles are 64-bit hashes; within a slice of
documents, and between slices, documents with equal sets are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .simhash import components
from .texts import slices, stored

#: Shingles of documents that are packed together, and entries of the matrix in one task.
SLICE_SHINGLES, BUCKET_ENTRIES = 1_000_000, 2_000_000
#: Rows of a block that one task multiplies; larger blocks are dealt as pairs of parts.
BLOCK_ROWS = 16_384
_HUBS = 24
#: Holders of shingles that are counted at once.
_HELD = 4_000_000

_PACKED = "bucket long, slice long, slots binary, owners binary, classes array<long>, sizes array<long>"


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """Sorted different hashes of a text's shingles, lower-cased in A-Z; a text with fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(w, 42) for w in words], dtype=np.uint64)
    count = max(1, len(words) - shingle_words + 1) if words else 0
    mixed = np.full(count, len(words) if len(words) < shingle_words else shingle_words, dtype=np.uint64)
    for at in range(min(shingle_words, len(words))):
        mixed = (mixed ^ values[at : at + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """Of so many shingles one must be shared by any set that is linked."""
    return size - (percent * size + 99) // 100 + 1


def jaccard_components(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80,
    slice_shingles: int = SLICE_SHINGLES, bucket_entries: int = BUCKET_ENTRIES, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Components of documents whose shingle sets overlap by ``percent`` of their union or more.

    Returns doc_id, n_shingles (size of the set) and component_id: the smallest doc_id that links reach,
    its own included. A text with fewer words than a shingle is one shingle; a null text or one without
    words has an empty set and links with nothing. Null doc_ids are linked but name no component unless
    all are null. Repeated rows come back as often as they are given; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, int(volume // 6 // bucket_entries) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, np.ndarray]] = []
        total = 0
        for batch in batches:
            for rows in slices(batch, "text"):
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                    hashes = shingle_hashes(text, shingle_words)
                    held.append((doc_id, hashes))
                    total += len(hashes)
                    if total >= slice_shingles:
                        yield from _packed(held, buckets, arrow_kind)
                        held, total = [], 0
        if held:
            yield from _packed(held, buckets, arrow_kind)

    schema = f"{_PACKED}, doc_ids array<{kind}>, doc_classes array<long>, doc_sizes array<long>"
    packed = docs.select("doc_id", "text").mapInArrow(pack, schema)
    shared = stored(packed.groupBy("bucket").applyInArrow(_shared_entries, schema), "shared_shingles")

    def assemble(table: pa.Table) -> pa.Table:
        return _candidate_rows(table, percent)

    listed = shared.filter("doc_ids IS NOT NULL").select(F.explode(F.arrays_zip("doc_ids", "doc_classes", "doc_sizes")).alias("d"))
    marked = listed.select("d.*").toDF("doc_id", "class", "n_shingles")
    rows = stored(
        shared.drop("doc_ids", "doc_classes", "doc_sizes").groupBy("slice")
        .applyInArrow(assemble, "class long, size long, slots binary, keys array<long>")
        .dropDuplicates(["class"]),
        "matrix_rows",
    )
    links = _product(rows, percent, block_rows)
    roots = components(links).withColumnRenamed("node", "class")
    classes = marked.groupBy("class").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    rooted = (
        classes.join(roots, "class", "left")
        .filter("copies > 1 OR root IS NOT NULL")
        .select("class", "first_id", F.coalesce("root", "class").alias("root"))
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(names, "root").select("class", "component_id")
    # Empty sets are equal, but not linked.
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return marked.join(groups, "class", "left").select("doc_id", "n_shingles", F.coalesce(linked, "doc_id").alias("component_id"))


def _packed(held: list, buckets: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A slice of documents: one row naming its documents and sets, and its shingles by bucket."""
    places: dict[int, int] = {}
    owners: list[int] = []
    sets: list[np.ndarray] = []
    for _, hashes in held:
        digest = xxhash.xxh64_intdigest(hashes.tobytes(), 42) - (1 << 63)
        if digest not in places:
            places[digest] = len(sets)
            sets.append(hashes)
        owners.append(places[digest])
    classes = list(places)
    name = xxhash.xxh64_intdigest(repr([(doc_id, classes[o]) for (doc_id, _), o in zip(held, owners, strict=True)]).encode()) >> 1
    sizes = [len(s) for s in sets]
    slots = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    order = np.argsort(slots)
    slots, owner = slots[order], owner[order]
    starts = [(b << 64) // buckets for b in range(buckets)]
    ends = [*np.searchsorted(slots, np.array(starts[1:], dtype=np.uint64)).tolist(), len(slots)]
    documents = [d for d, _ in held], [classes[o] for o in owners], [sizes[o] for o in owners]
    rows, begin = [(name % buckets, name, None, None, classes, sizes, *documents)], 0
    for bucket, end in enumerate(ends):
        if end > begin:
            rows.append((bucket, name, slots[begin:end].tobytes(), owner[begin:end].tobytes(), *[None] * 5))
        begin = end
    yield _batch(rows, kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), longs, longs, pa.list_(kind), longs, longs]
    names = ["bucket", "slice", "slots", "owners", "classes", "sizes", "doc_ids", "doc_classes", "doc_sizes"]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _shared_entries(table: pa.Table) -> pa.Table:
    """Of one bucket, the entries of shingles that several sets have, with the number of sets; other rows as they are."""
    is_entry = pc.is_valid(table["slots"])
    entries = table.filter(is_entry)
    kind = table.schema.field("doc_ids").type.value_type
    out = [table.filter(pc.invert(is_entry))]
    if len(entries):
        slots = [np.frombuffer(s.as_py(), np.uint64) for s in entries["slots"]]
        every = np.concatenate(slots)
        order = np.argsort(every)
        ranked = every[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        counts = np.empty(len(every), np.uint32)
        held = np.diff(np.append(first, len(ranked)))
        counts[order] = np.repeat(np.minimum(held, 0xFFFFFFFF), held)
        rows, begin = [], 0
        for bucket, name, own, owners in zip(
            entries["bucket"].to_pylist(), entries["slice"].to_pylist(), slots, entries["owners"].to_pylist(), strict=True
        ):
            part = counts[begin : begin + len(own)]
            begin += len(own)
            kept = part > 1
            if kept.any():
                triple = np.empty(int(kept.sum()), np.dtype([("slot", "<u8"), ("sets", "<u4")]))
                triple["slot"], triple["sets"] = own[kept], part[kept]
                rows.append((bucket, name, triple.tobytes(), np.frombuffer(owners, np.uint32)[kept].tobytes(), *[None] * 5))
        out.append(pa.Table.from_batches([_batch(rows, kind)]).cast(table.schema))
    return pa.concat_tables(out)


def _candidate_rows(table: pa.Table, percent: int) -> pa.Table:
    """The sets of one slice whose prefix holds a shared shingle: their shared shingles, and those of the prefix."""
    schema = pa.schema([("class", pa.int64()), ("size", pa.int64()), ("slots", pa.binary()), ("keys", pa.list_(pa.int64()))])
    head = table.filter(pc.is_valid(table["classes"])).to_pylist()
    entries = table.filter(pc.is_valid(table["slots"]))
    if not head or not len(entries):
        return schema.empty_table()
    # Slices that hold the same rows have one name; they hold the same sets too.
    classes, sizes = head[0]["classes"], np.array(head[0]["sizes"], np.int64)
    entry = np.dtype([("slot", "<u8"), ("sets", "<u4")])
    held = np.concatenate([np.frombuffer(s.as_py(), entry) for s in entries["slots"]])
    owner = np.concatenate([np.frombuffer(o.as_py(), np.uint32) for o in entries["owners"]])
    order = np.lexsort((held["slot"], held["sets"], owner))
    held, owner = held[order], owner[order]
    if len(head) > 1:  # the entries came once per slice
        keep = np.concatenate([[True], (owner[1:] != owner[:-1]) | (held["slot"][1:] != held["slot"][:-1])])
        held, owner = held[keep], owner[keep]
    starts = np.searchsorted(owner, np.arange(len(sizes) + 1, dtype=np.uint32)) if len(sizes) else np.zeros(1, int)
    counts = np.diff(starts)
    in_prefix = prefix_length(sizes, percent) - (sizes - counts)
    rows = []
    for place in np.flatnonzero((in_prefix > 0) & (counts > 0)).tolist():
        own = held["slot"][starts[place] : starts[place + 1]]
        rows.append((classes[place], int(sizes[place]), own.tobytes(), own[: in_prefix[place]].view(np.int64).tolist()))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _product(rows: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Links (node, other) between linked rows, enough to connect all of them."""
    keyed = rows.select("class", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("class").alias("hub"), F.count("*").alias("held")).filter("held > 1")
    near = keyed.join(hubs, "key").filter("class <> hub").selectExpr("class AS node", "hub AS other").distinct()
    blocks = components(near).selectExpr("node AS class", "root AS block")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("held"))
    parts = F.expr(f"CAST((held + {block_rows - 1}) div {block_rows} AS INT)")
    dealt = (
        blocks.join(sizes, "block")
        .withColumn("parts", parts)
        .withColumn("part", F.expr("CAST(pmod(xxhash64(class, 5), parts) AS INT)"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .selectExpr("class", "block", "part", "least(part, other) AS one", "greatest(part, other) AS two")
    )
    members = dealt.join(rows.select("class", "size", "slots"), "class")

    def multiply(table: pa.Table) -> pa.Table:
        slots = [np.frombuffer(s.as_py(), np.uint64) for s in table["slots"]]
        labels = overlap_labels(slots, table["size"].to_numpy(), percent)
        names = table["class"].to_numpy()
        linked = labels != np.arange(len(names))
        return pa.table({"node": names[linked], "other": names[labels[linked]]})

    return stored(members.groupBy("block", "one", "two").applyInArrow(multiply, "node long, other long"), "links")


def overlap_labels(slots: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """For rows of the matrix, the first place of each one's component of linked rows.

    Rows are multiplied with all rows of a fitting size, one at a time, through the lists of rows that
    hold a shingle. First some that hold the most common shingles, which connects copies of one text;
    then all rows outside the largest component.
    """
    count = len(slots)
    labels = np.arange(count)
    if count < 2:
        return labels
    lengths = np.array([len(s) for s in slots])
    every = np.concatenate(slots)
    owner = np.repeat(np.arange(count), lengths)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    column = np.empty(len(every), np.int64)
    column[order] = np.cumsum(first) - 1
    holders = owner[order]
    starts = np.append(np.flatnonzero(first), len(ranked))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    spread = np.diff(starts)
    weight = np.add.reduceat(spread[column], begins[:-1]) if lengths.all() else np.array([spread[column[a:b]].sum() for a, b in zip(begins, begins[1:], strict=False)])
    done = np.zeros(count, bool)

    def multiply(row: int) -> None:
        done[row] = True
        columns = column[begins[row] : begins[row + 1]]
        columns = columns[spread[columns] > 1]
        ends = np.cumsum(spread[columns])
        overlap = np.zeros(count, np.int64)
        for part in np.split(columns, np.searchsorted(ends, np.arange(_HELD, ends[-1], _HELD)) if len(ends) else []):
            if len(part):
                overlap += np.bincount(np.concatenate([holders[starts[c] : starts[c + 1]] for c in part.tolist()]), minlength=count)
        overlap[row] = 0
        size = sizes[row]
        # 100 * overlap >= percent * union, where the union is both sizes less the overlap.
        near = np.flatnonzero((100 + percent) * overlap >= percent * (sizes + size))
        near = near[overlap[near] > 0]
        if len(near):
            joined = np.unique(np.append(labels[near], labels[row]))
            if len(joined) > 1:
                labels[np.isin(labels, joined)] = joined[0]

    def largest() -> np.ndarray:
        return labels == np.bincount(labels, minlength=count).argmax()

    for _ in range(min(_HUBS, count)):
        open_rows = np.flatnonzero(~done & ~largest()) if done.any() else np.arange(count)
        if not len(open_rows):
            return labels
        multiply(int(open_rows[weight[open_rows].argmax()]))
    for row in np.flatnonzero(~done & ~largest()).tolist():
        multiply(row)
    return labels
