"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

The model is counted on trusted text. Its tables hold, for each n-gram seen, the interpolated
probability of its last character, and for each context the weight left to shorter contexts; they
come from joins of counts on contexts and on shorter n-grams. Both are sharded by the last context
character, which all tables needed for one character share; only the single characters, at most
65,536, are in every shard. Documents send each shard their n-grams with counts, packed, and the
shard's join gives partial log-probabilities, which add up to each document's perplexity.

Characters are code points; those beyond U+FFFE count as one. An n-gram of four is one 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .texts import slices, stored

ORDER = 4
_START = "\x02" * (ORDER - 1)
_MASK = (1 << 16) - 1


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams ending at every character of the texts, and the number of each one's text."""
    line = "".join(_START + t for t in texts).encode("utf-32-le", "surrogatepass")
    codes = np.minimum(np.frombuffer(line, dtype="<u4"), _MASK).astype(np.uint64)
    lengths = np.array([len(t) + len(_START) for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)
    begins = np.cumsum(lengths) - lengths
    real = np.arange(len(codes)) - begins[text] >= len(_START)
    packed = codes.copy()
    for back in range(1, ORDER):
        packed[back:] |= codes[: len(codes) - back] << np.uint64(16 * back)
    return packed[real], text[real]


def count_grams(texts: DataFrame) -> DataFrame:
    """gram and n of all n-grams of the highest order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                grams, counts = np.unique(_grams([t or "" for t in rows.column("text").to_pylist()])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], ["gram", "n"])

    return texts.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """The model's tables as rows: kind ('p' or 'b'), size, gram, log.

    'p': log-probability of an n-gram's last character after the rest; 'b': log of the weight that a
    context of ``size`` characters leaves to shorter ones. Below the highest order an n-gram counts as
    often as there are different characters before it. Discounts are those of Chen and Goodman, from
    four counts of counts per order.
    """
    levels = [counts]
    for size in range(ORDER - 1, 0, -1):
        shorter = levels[-1].withColumn("gram", F.col("gram").bitwiseAND((1 << 16 * size) - 1))
        levels.append(stored(shorter.groupBy("gram").agg(F.count("*").alias("n")), "grams"))
    levels.reverse()
    lower, tables = None, []
    for size, level in enumerate(levels, 1):
        tally = level.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first()
        discounts = _discounts([float(x) for x in tally])
        discount = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
        context = F.shiftrightunsigned("gram", 16)
        split = level.select("gram", "n", context.alias("context"), discount.alias("cut"))
        sums = split.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("given"))
        weights = sums.select("context", "total", (F.col("given") / F.col("total")).alias("weight"))
        joined = split.join(weights, "context").withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
        if lower is None:
            every = Window.partitionBy()
            joined = joined.withColumn("below", 1.0 / (F.count("*").over(every) + 1))
        else:
            shorter = lower.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
            joined = joined.withColumn("tail", F.col("gram").bitwiseAND((1 << 16 * (size - 1)) - 1)).join(shorter, "tail")
        lower = stored(joined.select("gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p")), "probabilities")
        tables.append(lower.select(F.lit("p").alias("kind"), F.lit(size).alias("size"), "gram", F.log("p").alias("log")))
        tables.append(
            weights.select(F.lit("b").alias("kind"), F.lit(size - 1).alias("size"), F.col("context").alias("gram"), F.log("weight").alias("log"))
        )
    model = tables[0]
    for table in tables[1:]:
        model = model.unionByName(table)
    return model


def _discounts(tally: list[float]) -> list[float]:
    one, two, three, four = tally
    if not one or not two:
        return [0.5, 0.5, 0.5]
    y = one / (one + 2 * two)
    found = [1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three if three else 0.0]
    return [min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1)]


class _Tables:
    """A shard of the model as sorted arrays."""

    def __init__(self, kinds: list[str], sizes: np.ndarray, grams: np.ndarray, logs: np.ndarray):
        self.found = {}
        kinds = np.array(kinds, dtype="U1")
        grams = grams.view(np.uint64)
        for kind in "pb":
            for size in range(ORDER + 1):
                mine = np.flatnonzero((kinds == kind) & (sizes == size))
                order = mine[np.argsort(grams[mine])]
                self.found[kind, size] = grams[order], logs[order]

    def _look(self, kind: str, size: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, logs = self.found[kind, size]
        if not len(keys):
            return np.zeros(len(grams), dtype=bool), np.zeros(len(grams))
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        return keys[at] == grams, logs[at]

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Of each n-gram's last character: the longest n-gram seen, and the weights of the longer contexts seen."""
        result, open_ = np.zeros(len(grams)), np.ones(len(grams), dtype=bool)
        for size in range(ORDER, 0, -1):
            tail = grams & np.uint64((1 << 16 * size) - 1)
            seen, log = self._look("p", size, tail)
            result[open_ & seen] += log[open_ & seen]
            open_ &= ~seen
            left, log = self._look("b", size - 1, tail >> np.uint64(16))
            result[open_ & left] += log[open_ & left]
        # A character never seen: one more in the number of characters that the rest is shared by.
        result[open_] -= np.log(len(self.found["p", 1][0]) + 1)
        return result


def _shard(grams: np.ndarray, shards: int) -> np.ndarray:
    return ((grams >> np.uint64(16) & np.uint64(_MASK)) * np.uint64(40503) >> np.uint64(4)) % np.uint64(shards)


def perplexities(docs: DataFrame, model: DataFrame, shards: int = 8, block_bytes: int = 64_000_000) -> DataFrame:
    """doc_id, text_hash (xxhash64), lang, n (characters) and log_sum of whole texts, one row per doc_id, text and lang.

    A text that is null or empty has n 0. Each block of about ``block_bytes`` of text meets each shard
    of the model in one task, so the model is sent once per block.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / block_bytes))
    # The context of a size-n n-gram ends where its last character begins; a context row is that itself.
    last = F.when(F.col("kind") == "p", F.shiftrightunsigned("gram", 16)).otherwise(F.col("gram")).bitwiseAND(_MASK)
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    own = F.pmod(F.shiftright(last * 40503, 4), F.lit(shards)).cast("int")
    everywhere = ((F.col("kind") == "p") & (F.col("size") == 1)) | ((F.col("kind") == "b") & (F.col("size") == 0))
    placed = model.select(F.explode(F.when(everywhere, every).otherwise(F.array(own))).alias("shard"), "kind", "size", "gram", "log")
    copies = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for rows in slices(batch, "text"):
                yield from _packed(rows, shards, blocks, squeeze)

    heads = "doc_ids array<long>, hashes array<long>, langs array<string>"
    packed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("lang").cast("string"), "text").mapInArrow(
        pack, f"shard int, block int, {heads}, grams binary"
    )

    def score(tables: pa.Table, rows: pa.Table) -> pa.Table:
        return _scored(tables, rows)

    partial = (
        copies.groupBy("shard", "block")
        .cogroup(packed.groupBy("shard", "block"))
        .applyInArrow(score, "doc_id long, text_hash long, lang string, n long, log_sum double")
    )
    return partial.groupBy("doc_id", "text_hash", "lang").agg(F.sum("n").alias("n"), F.sum("log_sum").alias("log_sum"))


def _packed(rows: pa.RecordBatch, shards: int, blocks: int, squeeze: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
    """The n-grams of a run of documents with the documents that hold them, one row per shard."""
    grams, text = _grams([t or "" for t in rows.column("text").to_pylist()])
    order = np.argsort(grams, kind="stable")
    grams, text = grams[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])])) if len(grams) else np.zeros(0, int)
    counts = np.diff(np.append(first, len(grams))).astype("<u4")
    grams, text = grams[first], text[first].astype("<u4")
    shard = _shard(grams, shards)
    ids, hashes, langs = (rows.column(c).to_pylist() for c in ("doc_id", "text_hash", "lang"))
    block = hash((ids[0], hashes[0], len(ids))) % blocks if ids else 0
    for number in range(shards):
        mine = shard == number
        if not mine.any() and number:  # the first shard names all documents, those without text too
            continue
        own, sizes = np.unique(grams[mine], return_counts=True)
        steps = np.diff(own, prepend=np.uint64(0)).astype("<u8")
        data = b"".join(
            [len(own).to_bytes(4, "little"), int(mine.sum()).to_bytes(4, "little"), steps.tobytes(),
             sizes.astype("<u4").tobytes(), *(_planes(x[mine]) for x in (text, counts))]
        )
        columns = [
            pa.array([number], pa.int32()), pa.array([block], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([hashes], pa.list_(pa.int64())), pa.array([langs], pa.list_(pa.string())),
            pa.array([squeeze.compress(data)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "doc_ids", "hashes", "langs", "grams"])


def _planes(values: np.ndarray) -> bytes:
    """Low bytes first, then the next ones: small numbers compress well."""
    return values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def _scored(tables: pa.Table, rows: pa.Table) -> pa.Table:
    model = _Tables(*(tables[c].to_pylist() if c == "kind" else tables[c].to_numpy() for c in ("kind", "size", "gram", "log")))
    found: list[list] = [[], [], [], [], []]
    for ids, hashes, langs, data in zip(*(rows[c].to_pylist() for c in ("doc_ids", "hashes", "langs", "grams")), strict=True):
        data = zstandard.ZstdDecompressor().decompress(data)
        kinds, entries = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
        grams = np.cumsum(np.frombuffer(data, "<u8", kinds, 8), dtype=np.uint64)
        sizes = np.frombuffer(data, "<u4", kinds, 8 + 8 * kinds)
        rest = np.frombuffer(data, "u1", 8 * entries, 8 + 12 * kinds).reshape(2, 4, entries)
        text, counts = (np.ascontiguousarray(x.T).view("<u4").ravel().astype(np.int64) for x in rest)
        logs = np.repeat(model.log_probability(grams), sizes) * counts
        found[0] += ids
        found[1] += hashes
        found[2] += langs
        found[3] += np.bincount(text, counts, len(ids)).astype(np.int64).tolist()
        found[4] += np.bincount(text, logs, len(ids)).tolist()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64()]
    names = ["doc_id", "text_hash", "lang", "n", "log_sum"]
    return pa.table([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names)


#: Shares of held-out trusted text that a threshold may keep, the loosest first.
QUANTILES = (0.99, 0.98, 0.97, 0.96, 0.95)
#: Labelled low-quality texts from which a language chooses its own quantile.
_LEAST_LOW = 20


#: Ids of training documents that are sent to every task; more are joined by a shuffle.
_SENT_IDS = 1_000_000


def classify_quality(docs: DataFrame, labels: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Perplexity of every document, and whether to keep it.

    ``docs`` needs doc_id, text and lang; ``labels`` has doc_id and quality (1: trusted, 0: low). The
    model is fitted on all documents of one half of the trusted ones, taken by hash. The other half and the
    low ones set the thresholds: of the ``quantiles`` of trusted perplexities, each language takes the one with the largest share of trusted text kept less the share of low text kept,
    the looser of equal ones. A quantile q needs 1 / (1 - q) trusted texts; a language with too few for
    any takes the threshold of all languages, one with few low texts the quantile of all. A document is
    kept if its perplexity is not above the threshold.

    Returns doc_id, text_hash (xxhash64 of the text), lang, n, perplexity, threshold and keep, one row
    per doc_id, text and lang: repeated rows are one. Null and empty texts have no perplexity and are
    not kept. Without trusted text all other documents are kept. Null doc_ids are scored like others;
    a null language is one of its own. Further columns are ignored; of several labels of one doc_id
    any 1 counts.
    """
    docs = docs.select("doc_id", "text", "lang")
    trusted = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id")).distinct()
    chosen = stored(trusted.filter("xxhash64(id) % 2 = 0"), "trained")
    fit_on = docs.join(F.broadcast(chosen) if chosen.count() <= _SENT_IDS else chosen, F.col("doc_id").cast("long") == F.col("id"), "left_semi")
    model = stored(kneser_ney(stored(count_grams(fit_on), "grams")), "model")
    scores = stored(
        perplexities(docs, model).withColumn("perplexity", F.when(F.col("n") > 0, F.exp(-F.col("log_sum") / F.col("n")))),
        "perplexities",
    )
    marks = labels.filter("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.max("quality") == 1).alias("good"))
    held_out = stored(
        scores.filter("n > 0").join(marks, F.col("doc_id") == F.col("id")).filter(~F.col("good") | (F.xxhash64("id") % 2 != 0)).select("lang", "perplexity", "good"),
        "held_out",
    )
    overall = _levels(held_out.withColumn("lang", F.lit(None).cast("string")), quantiles)
    overall = overall.withColumn("pick", F.coalesce(_best(quantiles), F.lit(0)))
    overall = overall.select(F.col("pick").alias("every_pick"), F.col("levels")[F.col("pick")].alias("overall"))
    by_lang = _levels(held_out, quantiles).crossJoin(F.broadcast(overall))  # one row
    usable = F.lit(0)
    for q in quantiles:
        usable += F.when(F.col("n_good") < _texts_for(q), 1).otherwise(0)
    pick = F.when(F.col("n_low") < _LEAST_LOW, F.greatest("every_pick", usable)).otherwise(_best(quantiles))
    by_lang = by_lang.withColumn("own", F.when(usable < len(quantiles), F.col("levels")[pick])).select(F.col("lang").alias("of"), "own")
    return (
        scores.join(F.broadcast(overall), F.lit(True), "left")  # one row, or none
        .join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
        .withColumn("threshold", F.coalesce("own", "overall"))
        .withColumn("keep", F.coalesce((F.col("n") > 0) & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold"))), F.lit(False)))
        .select("doc_id", "text_hash", "lang", "n", "perplexity", "threshold", "keep")
    )


def _texts_for(quantile: float) -> int:
    """Texts below which a quantile would be the single worst one."""
    return ceil(round(1 / (1 - quantile), 6))


def _levels(held_out: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """lang, n_good, n_low, the perplexity at each quantile (levels), and how many texts of both kinds each keeps."""
    good = F.when(F.col("good"), F.col("perplexity"))
    levels = held_out.groupBy("lang").agg(F.percentile_approx(good, list(quantiles), 10_000).alias("levels"))
    levels = levels.withColumnRenamed("lang", "of")
    kept = [F.col("perplexity") <= F.col("levels")[i] for i in range(len(quantiles))]
    return (
        held_out.join(levels, F.col("lang").eqNullSafe(F.col("of")))
        .groupBy("lang")
        .agg(
            F.first("levels").alias("levels"), F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_low"),
            F.array(*[F.count_if(F.col("good") & k) for k in kept]).alias("good_kept"),
            F.array(*[F.count_if(~F.col("good") & k) for k in kept]).alias("low_kept"),
        )
    )


def _best(quantiles: tuple[float, ...]):
    """Number of the quantile that tells the two kinds apart best; null where no quantile has enough texts."""
    gains = []
    for i, q in enumerate(quantiles):
        low = F.when(F.col("n_low") > 0, F.col("low_kept")[i] / F.col("n_low")).otherwise(0.0)
        gain = F.col("good_kept")[i] / F.col("n_good") - low
        gains.append(F.when(F.col("n_good") >= _texts_for(q), F.struct(gain.alias("gain"), F.lit(-i).alias("loose"))))
    return -F.array_max(F.array(*gains))["loose"]
