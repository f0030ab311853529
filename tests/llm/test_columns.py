"""Further columns of the caller change nothing, whatever their names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgersieve.llm.ann import nearest_by_cosine
from ledgersieve.llm.bpe import encode_documents
from ledgersieve.llm.conversations import damaged_turns, every_conversation, repair_conversations, repaired_digests
from ledgersieve.llm.jaccard import jaccard_components
from ledgersieve.llm.licenses import scan_licenses
from ledgersieve.llm.mixing import mix_sources
from ledgersieve.llm.mtree import top_inner_products
from ledgersieve.llm.negatives import mine_negatives
from ledgersieve.llm.pages import extract_main_text
from ledgersieve.llm.quality import classify_quality
from ledgersieve.llm.simhash import near_duplicates
from ledgersieve.llm.suffixes import cut_repeats
from ledgersieve.llm.wavelet import read_shards, write_shards

NAMES = (
    "id", "_id", "_hash", "_key", "_places", "key", "rank", "row", "root", "node", "other", "hub", "block", "shard", "slice", "bucket", "draw",
    "class", "at", "part", "number", "n", "size", "target", "taken", "place", "score", "query_id", "keep", "gram", "head", "kind", "lines", "host",
    "digest", "audit", "fingerprint", "component_id", "text_hash", "v", "highs", "c0", "c1",
)


@pytest.fixture(scope="module")
def data(spark):
    words = [" ".join(f"w{(i * k) % 37}" for i in range(60)) for k in (1, 2, 3, 5, 5)]
    docs = spark.createDataFrame(
        [(i, f"{t} Licensed under the MIT License.", "en", f"s{i % 2}") for i, t in enumerate([*words, "", None])],
        "doc_id long, text string, lang string, source string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, -float(i % 3)], i % 2) for i in range(0, 300, 5)], "vec_id long, embedding array<double>, label int")
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", f"<div>Menu</div><p>own {i}</p>") for i in range(4)], "page_id long, url string, html string")
    turns = spark.createDataFrame([(1, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(9)], "conv_id long, turn long, role string, text string")
    return {"docs": docs, "labels": labels, "vectors": vectors, "pages": pages, "turns": turns}


def repaired(turns):
    damaged = damaged_turns(turns)
    return repaired_digests(damaged, every_conversation(repair_conversations(damaged), turns))


LIBRARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
OPERATORS = {
    "mtree": lambda d: top_inner_products(d["vectors"], every=10, k=3, scale=8),
    "mixing": lambda d: mix_sources(d["docs"]),
    "quality": lambda d: classify_quality(d["docs"], d["labels"]).withColumn("perplexity", F.round("perplexity", 9)).withColumn("threshold", F.round("threshold", 9)),
    "licenses": lambda d: scan_licenses(d["docs"]),
    "ann": lambda d: nearest_by_cosine(d["vectors"], every=10, k=2),
    "simhash": lambda d: near_duplicates(d["docs"], 3, 3).drop("root"),
    "wavelet": lambda d: read_shards(write_shards(d["docs"], LIBRARY, end_id=2)),
    "bpe": lambda d: encode_documents(d["docs"], RANKS, public_tokenizers.PATTERN),
    "pages": lambda d: extract_main_text(d["pages"]),
    "suffixes": lambda d: cut_repeats(d["docs"], 13).select("doc_id", "n_words", "n_removed", "kept", "spans"),
    "conversations": lambda d: repaired(d["turns"]),
    "negatives": lambda d: mine_negatives(d["vectors"], every=10, scale=8),
    "jaccard": lambda d: jaccard_components(d["docs"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_name_of_a_column_matters(name, data):
    wider = {
        table: frame.select("*", *[F.lit(f"of {c}").alias(c) for c in NAMES if c not in frame.columns]) for table, frame in data.items()
    }
    plain, found = (sorted(map(str, OPERATORS[name](frames).collect())) for frames in (data, wider))
    assert plain == found and plain
