"""The Jaccard join against brute force over sets of word tuples."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

from ledgersieve.llm.jaccard import jaccard_components, overlap_labels, prefix_length
from ledgersieve.llm.queries import all_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def plain_set(text, size=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_components(rows):
    """Rows as the query gives them, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    labels = np.arange(len(rows))
    for one in range(len(rows)):
        for other in range(one):
            common = len(sets[one] & sets[other])
            if common and 100 * common >= 80 * (len(sets[one]) + len(sets[other]) - common):
                labels[labels == labels[one]] = labels[other]
    smallest = {}
    for (doc_id, _), label in zip(rows, labels, strict=True):
        if doc_id is not None:
            smallest[label] = min(doc_id, smallest.get(label, doc_id))
    return sorted(((d, len(s), smallest.get(c)) for (d, _), s, c in zip(rows, sets, labels, strict=True)), key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family_rows(seed, families=60, copies=12):
    """Families of edited copies, some just below and some just above the bound, around shared passages."""
    rng = random.Random(seed)
    footer = [f"f{i}" for i in range(40)]
    rows = []
    for _ in range(families):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(5, 150))] + footer * rng.randint(0, 1)
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randint(0, copies)):
            edited = list(words)
            for at in rng.sample(range(len(words)), rng.randint(0, max(1, len(words) // 12))):
                edited[at] = f"x{rng.randrange(300)}"
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(edited).upper() if rng.random() < 0.1 else " ".join(edited)))
    return rows


def test_components_are_those_of_all_pairs(spark, docs_of, conf):
    rows = family_rows(3) + [(5000 + i, "one text in many copies of it") for i in range(200)]
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "a b"), (9004, "A\tB"), (9005, "a"), (None, "a b"), (None, "alone here"), (7, rows[0][1]), (7, rows[0][1])]
    rows += [(9100, "z " * 30_000), (9101, "Z " * 20_000)]
    expected = plain_components(rows)
    assert 100 < len({c for _, _, c in expected}) < len(rows) - 250
    for settings in ({}, {"slice_shingles": 500, "bucket_entries": 400}, {"block_rows": 4}):
        conf(spark__sql__execution__arrow__maxRecordsPerBatch="40")
        assert found(jaccard_components(docs_of(rows, parts=5), **settings)) == expected
    assert jaccard_components(docs_of([])).collect() == []
    assert found(jaccard_components(docs_of([(1, None)]))) == [(1, 0, 1)]


def test_clashing_columns_are_ignored(spark):
    docs = spark.sql("SELECT 1L AS doc_id, 'a b c d e f' AS text, 2 AS class, 3 AS size, 4 AS slots, 5 AS slice, 6 AS key, 7 AS bucket")
    assert found(jaccard_components(docs.unionAll(docs))) == [(1, 2, 1)] * 2


@pytest.mark.parametrize("held", [4_000_000, 7])
def test_product_of_a_block_against_all_pairs(held, monkeypatch):
    monkeypatch.setattr("ledgersieve.llm.jaccard._HELD", held)
    rng = np.random.default_rng(1)
    for seed in range(30):
        size = rng.integers(2, 40)
        base = rng.choice(80, 30, replace=False)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(3, 28), replace=False), rng.integers(100, 140, rng.integers(0, 4))])).astype(np.uint64) for _ in range(size)]
        sizes = np.array([len(s) + rng.integers(0, 2) for s in sets])
        labels = np.arange(size)
        for one in range(size):
            for other in range(one):
                common = len(np.intersect1d(sets[one], sets[other]))
                if 100 * common >= 80 * (sizes[one] + sizes[other] - common):
                    labels[labels == labels[one]] = labels[other]
        got = overlap_labels(sets, sizes, 80)
        groups = lambda marks: sorted(tuple(np.flatnonzero(marks == m)) for m in set(marks.tolist()))
        assert groups(got) == groups(labels)


def test_prefix_holds_what_a_link_must_share():
    sizes = np.arange(1, 200)
    # The fewest shared shingles of a linked set of this size, and one more than what is left beside them.
    assert (prefix_length(sizes, 80) == [n - -(-80 * n // 100) + 1 for n in sizes]).all()


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")
def test_query_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(all_queries()["op13_jaccard_product"](spark, FOLDER)) == plain_components(rows)
