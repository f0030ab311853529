"""SimHash components and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash

from corpus_pipeline import drop_near_duplicates
from ledgersieve.llm.simhash import components, near_duplicates, near_labels, text_fingerprint
from ledgersieve.llm.suffixes import cut_repeats, kept_digests

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_labels(prints, bits=3):
    labels = np.arange(len(prints))
    for one in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[one] ^ prints) <= bits)
        joined = np.unique(labels[near])
        labels[np.isin(labels, joined)] = joined[0]
    return labels


def test_fingerprint_follows_its_definition():
    for text in ("", None, " \t", "One", "one TWO", "Äpfel\xa0und BIRNEN sind Obst " * 5, "a b c d e f g"):
        for size in (3, 5):
            assert text_fingerprint(text, size) == plain_fingerprint(text, size)


def test_tree_finds_every_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rng.integers(0, 63, (20, 2))]
    prints = np.unique(np.concatenate([base, np.array(near, np.uint64), rng.integers(0, 2**63, 2000, dtype=np.uint64)]))
    rng.shuffle(prints)
    assert (near_labels(prints, 3) == plain_labels(prints)).all()


def test_components_over_shards(spark, docs_of):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(500):
        if rows and rng.random() < 0.5:
            words = rng.choice(rows)[1].split()
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randint(60, 300))
        rows.append((i * 7 % 500, " ".join(words)))
    rows += [(600 + i, "the same text in many copies") for i in range(300)] + [(900, None), (901, ""), (None, "  "), (3, rows[0][1])]
    prints = np.array([plain_fingerprint(t, 3) for _, t in rows], dtype=np.uint64)
    labels = plain_labels(prints)
    smallest = {}
    for (doc_id, _), label in zip(rows, labels, strict=True):
        if doc_id is not None:
            smallest[label] = min(doc_id, smallest.get(label, doc_id))
    expected = sorted((d if d is not None else -1, int(p), smallest.get(c)) for (d, _), p, c in zip(rows, prints, labels, strict=True))
    for shard_rows in (32_768, 100):
        found = near_duplicates(docs_of(rows), 3, 3, shard_rows=shard_rows, sample_rows=90).collect()
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint % (1 << 64), r.component_id) for r in found)
        assert got == expected
    assert len(set(labels)) < len(rows) - 300
    assert near_duplicates(docs_of([])).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000 + i, 1000) for i in range(1, 200)] + [(5, 5)]
    found = dict(components(spark.createDataFrame(edges, "node long, other long")).collect())
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)}


def plain_cut(rows, window):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    order = lambda d: (d is None, d or 0)
    for doc_id, words in split:
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            first[run] = min(first.get(run, order(doc_id)), order(doc_id))
    out = []
    for doc_id, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < order(doc_id):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id if doc_id is not None else -1, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_are_cut_as_by_hand(spark, docs_of, conf):
    rng = random.Random(6)
    passages = [[f"p{i}-{j}" for j in range(rng.randint(10, 40))] for i in range(6)]
    rows = []
    for i in range(300):
        words = [f"u{rng.randrange(50)}" for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((i * 11 % 300, rng.choice(["  ", "\n", " \t", "\xa0 "]).join(words)))
    copy = " ".join(f"c{i % 30}" for i in range(200))
    rows += [(500 + i, copy) for i in range(150)] + [(5, copy), (5, copy), (None, copy), (None, None), (7, ""), (8, "z " * 30_000)]
    expected = plain_cut(rows, 13)
    for suffixes in (1_500_000, 1000):
        conf(spark__sql__execution__arrow__maxRecordsPerBatch="40")
        found = kept_digests(cut_repeats(docs_of(rows, parts=5), 13, suffixes)).collect()
        assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in found) == expected
    assert cut_repeats(docs_of([])).collect() == []


def test_spans_and_other_columns(spark, docs_of):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = cut_repeats(docs_of([(1, f"a {passage} b"), (2, f"x y {passage} z {passage}")]), 13).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].spans == [] and [tuple(s) for s in by_id[2].spans] == [(2, 22), (23, 43)]
    assert by_id[2].kept == "x y z" and by_id[2].size == "x" and by_id[2].lang == "en"


def test_pipeline_stage_keeps_one_of_each_component(spark, docs_of):
    words = [f"w{i}" for i in range(200)]
    near = [w if i != 40 else "x" for i, w in enumerate(words)]
    far = [f"v{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words)), (None, "a b"), (6, None), (7, "")]
    prints = np.array([plain_fingerprint(t, 3) for _, t in rows], dtype=np.uint64)
    labels = plain_labels(prints)
    first = {}
    for (doc_id, _), label in zip(rows, labels, strict=True):
        first[label] = min((x for x in (doc_id, first.get(label)) if x is not None), default=None)
    found = drop_near_duplicates(spark, docs_of(rows), "").collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(map(str, first.values()))
