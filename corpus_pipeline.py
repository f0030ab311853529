"""From raw documents to token ids: five operators, each working on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgersieve.llm.bpe import encode_documents
from ledgersieve.llm.mixing import mix_sources
from ledgersieve.llm.quality import classify_quality
from ledgersieve.llm.shipping import ship_package
from ledgersieve.llm.simhash import near_duplicates
from ledgersieve.llm.suffixes import cut_repeats
from ledgersieve.llm.texts import stored

_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_SHINGLE_WORDS, _MAX_BITS = 3, 3
_WINDOW = 13

#: SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold; documents without text go."""
    ship_package(spark)
    docs = docs.select(_COLUMNS)
    kept = classify_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("keep")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("lang").alias("_lang"))
    return docs.join(kept, _same_text(docs) & F.col("lang").eqNullSafe(F.col("_lang")), "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints: the one with the smallest doc_id, a null doc_id last.

    Texts without words have one fingerprint, so one of them stays.
    """
    ship_package(spark)
    docs = docs.select(_COLUMNS)
    found = near_duplicates(docs, _SHINGLE_WORDS, _MAX_BITS)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    return _one_of_each(docs.join(kept, _same_text(docs), "left_semi"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller doc_id has; documents left without a word go."""
    ship_package(spark)
    cut = cut_repeats(docs.select(_COLUMNS), _WINDOW)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    left = cut.filter("n_removed = 0 OR n_removed < n_words").withColumn("text", text)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; at a source's cut, the first words of one document."""
    ship_package(spark)
    docs = docs.select(_COLUMNS)
    taken = (
        mix_sources(docs)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("source").alias("_source"))
        .agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"))
        .filter("_taken > 0")
    )
    joined = docs.join(taken, _same_text(docs) & F.col("source").eqNullSafe(F.col("_source")))
    copies = _one_of_each(joined).withColumn("_copy", F.explode(F.expr("sequence(1L, (_taken + _size - 1) div _size)")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.expr("_taken - (_copy - 1) * _size")
    text = F.when(part < F.col("_size"), F.array_join(F.slice(words, F.lit(1), part.cast("int")), " ")).otherwise(F.col("text"))
    return copies.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    ship_package(spark)
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _same_text(docs: DataFrame):
    return docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))


def _one_of_each(docs: DataFrame) -> DataFrame:
    """Rows that are equal in doc_id and text once; after the joins above they lie together already."""
    return docs.withColumn("_text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
