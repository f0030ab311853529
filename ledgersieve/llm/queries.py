"""The operators over the given tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .ann import nearest_by_cosine
from .bpe import encode_documents
from .conversations import damaged_turns, every_conversation, repair_conversations, repaired_digests
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .mixing import mix_sources
from .mtree import top_inner_products
from .negatives import mine_negatives
from .pages import extract_main_text
from .quality import classify_quality
from .shipping import ship_package
from .simhash import near_duplicates
from .suffixes import cut_repeats, kept_digests
from .wavelet import read_shards, write_shards

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(_table(spark, folder, "embeddings"), every=100, k=10, scale=1024)


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classify_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels")).drop("text_hash")


def op4_license_compression(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op5_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_by_cosine(_table(spark, folder, "embeddings"), every=50, k=5)


def op6_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents"), shingle_words=3, max_bits=3)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_shards(write_shards(_table(spark, folder, "documents"), tokenizer, end_id=2))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN).drop("ids")


def op9_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(_table(spark, folder, "pages"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return kept_digests(cut_repeats(_table(spark, folder, "documents"), window=13))


def op11_grammar_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    turns = damaged_turns(conversations)
    return repaired_digests(turns, every_conversation(repair_conversations(turns), conversations))


def op12_threshold_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """With a wrong label for every seventh row."""
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = _table(spark, folder, "embeddings").withColumn("label", label)
    return mine_negatives(vectors, every=100, positives=5, negatives=5, scale=256, low=80)


def op13_jaccard_product(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"), shingle_words=5, percent=80)


_QUERIES = (
    op1_mtree_top_k, op2_mix_sources, op3_kneser_ney_quality, op4_license_compression, op5_adaptive_scan, op6_simhash_components,
    op7_wavelet_shards, op8_byte_bpe, op9_page_differencing, op10_suffix_dedup, op11_grammar_repair, op12_threshold_negatives,
    op13_jaccard_product,
)


def all_queries() -> dict[str, Query]:
    return {query.__name__: _shipped(query) for query in _QUERIES}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run
