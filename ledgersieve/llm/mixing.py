"""Mixing sources to target weights.

Every document draws a hash-random key. Within each source the documents are ranged by that key
into buckets, so a hot source is split as well as any; bucket totals give each bucket its offset,
and a window inside the bucket the rest of the prefix sum. A source is cut where its prefix sum
reaches its budget; whole epochs come before the cut if the budget exceeds the source.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from .texts import stored, word_count


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most_epochs: int = 2,
    seed: str = "mix",
    bucket_rows: int = 20_000,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` needs doc_id, text and source; further columns are ignored. Returns doc_id, text_hash
    (xxhash64 of the text), source, size (words), source_size, target (double), budget (the target in
    whole words) and taken.

    The sources, by code point and null last, get ``weights`` in turn. Together they are to give
    ``share`` of all words, none more than ``most_epochs`` times its own; what a source cannot give
    goes to the others by weight. ``taken`` adds up to each source's budget exactly: the document
    at the cut gives only its first words.

    Null and empty texts have size 0 and give nothing. Null doc_ids draw one common key. Rows with
    the same doc_id are taken shorter first, then by text_hash, so reruns agree. An empty table gives an empty result.
    """
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64("text").alias("text_hash"),
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw"),
        ),
        "sizes",
    )
    buckets = max(1, ceil(sized.count() / bucket_rows))
    first_bits = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    ranged = sized.withColumn("bucket", F.shiftright(first_bits * buckets, 32))

    heads = _bucket_heads(ranged, weights, share, most_epochs)
    rows = ranged.select("source", "bucket", "draw", "doc_id", "text_hash", "size", F.lit(False).alias("head")).unionByName(
        heads.select(
            "source", "bucket", F.lit("").alias("draw"), F.lit(True).alias("head"),
            F.col("before").alias("size"), "source_size", "target", "budget",
        ),
        allowMissingColumns=True,
    )
    # The head of a bucket comes first and counts all that lies before the bucket.
    bucket = Window.partitionBy("source", "bucket")
    earlier = bucket.orderBy(F.desc("head"), "draw", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        "doc_id", "text_hash", "source", "size", "head",
        F.sum("size").over(earlier).alias("before"),
        *[F.max(c).over(earlier).alias(c) for c in ("source_size", "target", "budget")],
    ).filter("NOT head")
    epochs = F.expr("IF(source_size = 0, 0L, budget div source_size)")
    cut = F.col("budget") - epochs * F.col("source_size") - F.col("before")
    return placed.select(
        "doc_id", "text_hash", "source", "size", "source_size", "target", "budget",
        (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), cut))).alias("taken"),
    )


def _bucket_heads(ranged: DataFrame, weights: tuple[int, ...], share: float, most_epochs: int) -> DataFrame:
    """One row per source and bucket: the words before it, and the source's size, target and budget.

    Sources get water-filled targets. In order of limit over weight, a source stays at its limit as
    long as that is below the level the rest of the budget allows; the highest such level is the
    common one. The two windows without a partition see one row per source.
    """
    totals = ranged.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1)
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "turn")
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("most").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ) / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    sources = (
        totals.groupBy("source")
        .agg(F.sum("bucket_size").alias("source_size"))
        .select("source", "source_size", turn.alias("turn"), weight.alias("weight"))
        .withColumn("most", F.col("source_size") * most_epochs)
        .withColumn("level", level)
        .withColumn("target", F.least(F.col("most").cast("double"), F.max("level").over(everything) * F.col("weight")))
        .withColumn("budget", F.least(F.col("most"), F.floor(F.col("target") + 0.5)))
        .select(F.col("source").alias("of"), "source_size", "target", "budget")
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).join(
        sources, F.col("source").eqNullSafe(F.col("of"))
    )
