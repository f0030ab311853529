"""Byte-level BPE against tiktoken, wavelet shards against plain arrays and the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from ledgersieve.llm.bpe import encode_documents, rank_encoder
from ledgersieve.llm.wavelet import LibraryEncoder, Shard, _Remembered, pack_shard, read_shards, write_shards

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
KNOWN = Tokenizer.from_file(LIBRARY)
TEXTS = [
    None, "", " ", "\n\n  a  b \t c ", "the the The", "don't we'll it's", "a" * 3000, " " * 500, "12345 678", "日本語 é ü ß 😀",
    "x\x1c y\x85 z\xa0w", "<|endoftext|> a <|endoftext|>", "word " * 20_000,
]
chunky = st.text(st.sampled_from(" \t\n\r\x0b\x1c\x85\xa0'srelthe .,!0129é日😀XYZ"), max_size=60)


@pytest.fixture(scope="module")
def ours():
    return rank_encoder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(chunky)
def test_ids_are_those_of_merging_by_rank(ours, theirs, text):
    ids = ours.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
    assert ours.decode(ids) == text.encode()


def test_every_document_round_trips(spark, docs_of, ours, theirs):
    found = encode_documents(docs_of([*enumerate(TEXTS), (None, "a"), (1, "b"), (1, "b")]), RANKS, PATTERN).collect()
    assert len(found) == len(TEXTS) + 3
    for row in found:
        if row.doc_id in (None, 1):
            continue
        ids = np.array(theirs.encode_ordinary(TEXTS[row.doc_id] or ""), dtype="<u4").tobytes()
        assert (row.n_tokens, row.ids, row.ids_sha256) == (len(ids) // 4, ids, hashlib.sha256(ids).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((TEXTS[row.doc_id] or "").encode()).hexdigest()
    assert encode_documents(docs_of([]), RANKS, PATTERN).collect() == []


@pytest.mark.parametrize("size,kinds", [(0, 1), (1, 1), (9, 1), (511, 2), (512, 3), (513, 3), (5000, 40), (3000, 50_000)])
def test_shard_answers_as_the_array_does(size, kinds):
    ids = np.random.default_rng(size).integers(0, kinds, size).astype("<u4")
    shard = Shard(pack_shard(ids, [size // 2, size - size // 2], [None, -5]))
    assert shard.doc_ids == [None, -5] and (shard.all_ids() == ids).all()
    assert [shard.access(i) for i in range(min(size, 70))] == ids[:70].tolist()
    for token in [*range(min(kinds, 4)), kinds + 1]:
        places = np.flatnonzero(ids == token).tolist()
        assert shard.occurrences(token) == places
        for end in (0, size // 3, size):
            assert shard.rank(token, end) == sum(p < end for p in places)
        assert shard.count(token, size // 4, size // 2) == sum(size // 4 <= p < size // 2 for p in places)
    assert (shard.document(0) == ids[: size // 2]).all()
    with pytest.raises(IndexError):
        shard.access(size)


@settings(max_examples=300, deadline=None)
@given(st.lists(chunky, max_size=4), st.booleans())
def test_chunks_are_encoded_as_whole_texts(texts, special):
    library, known = LibraryEncoder(LIBRARY, room=4_000), KNOWN
    texts = [t + "<|endoftext|>" + t for t in texts] if special else texts
    for text, ids in zip(texts, library.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


def test_shards_hold_all_documents_in_order(spark, docs_of):
    rows = [(len(TEXTS) - i, t) for i, t in enumerate(TEXTS)] + [(None, "none"), (3, "again"), (3, "again")]
    library = Tokenizer.from_file(LIBRARY)
    shards = write_shards(docs_of(rows), LIBRARY, end_id=2, shard_ids=50)
    assert shards.count() > 3
    found = sorted(map(tuple, read_shards(shards).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    start = 0
    for doc_id, at, count, crc in found:
        assert at == start
        start += count
        wanted = [np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for d, t in rows if d == doc_id]
        assert (count, crc) in {(len(w) // 4, zlib.crc32(w)) for w in wanted}
    assert read_shards(write_shards(docs_of([]), LIBRARY, end_id=2)).collect() == []


def test_chunks_of_words_marks_and_lines_are_encoded_as_whole_texts():
    rng, library, known = random.Random(9), LibraryEncoder(LIBRARY, room=20_000), KNOWN
    pieces = ["word", "Été", "x", ".", "...", "$$", "<|", "|>", "<|endoftext|>", "endoftext", "\n", "\n\n", "\t", "'s", "'", "9", "é\u0301", "\xa0", "W" * 100, "_", "~`"]
    texts = [" ".join("".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 8))) for _ in range(3_000)]
    found = library.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


def test_a_word_is_looked_up_once_a_batch(monkeypatch):
    asked = []
    monkeypatch.setattr(_Remembered, "__getitem__", lambda known, text: asked.append(text) or dict.__getitem__(known, text), raising=False)
    texts = ["One word, the word. The wörd!\nand a word " * 500] * 4
    assert _numbers(LibraryEncoder(LIBRARY).encode(texts)) == [KNOWN.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) < 30


def test_texts_with_wide_spaces_are_cut_too(monkeypatch):
    library, asked = LibraryEncoder(LIBRARY), []
    whole = library._ids
    monkeypatch.setattr(library, "_ids", lambda texts: asked.extend(texts) or whole(texts))
    texts = ["  if  word:\n    other(word)  # 9 words\x1c \xa0 \n\n  a " * 500, "a  b", "a b", " "]
    assert _numbers(library.encode(texts)) == [KNOWN.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, asked)) < 30


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_of_texts_are_encoded_as_they_come(kind):
    column = pa.array(["left out", *TEXTS, "left out"], kind).slice(1, len(TEXTS))
    wanted = [KNOWN.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert _numbers(LibraryEncoder(LIBRARY).encode(column)) == wanted


def _numbers(encoded):
    return [np.frombuffer(ids, "<u4").tolist() for ids in encoded]


def test_other_files_are_left_to_the_library(tmp_path):
    """A file with another way of splitting, one that changes texts, and one with a token like a word."""
    text = "The word, the Word.\nWORD endoftext word"
    changes = (
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.Sequence([pre_tokenizers.Digits(), pre_tokenizers.ByteLevel(add_prefix_space=False)])),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=True)),
        lambda t: setattr(t, "normalizer", normalizers.Lowercase()),
        lambda t: t.add_tokens(["word"]),
    )
    for number, change in enumerate(changes):
        tokenizer = Tokenizer.from_file(LIBRARY)
        change(tokenizer)
        path = str(tmp_path / f"{number}.json")
        tokenizer.save(path)
        ids = [np.frombuffer(x, "<u4").tolist() for x in LibraryEncoder(path).encode([text, ""])]
        assert ids == [tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "")]
