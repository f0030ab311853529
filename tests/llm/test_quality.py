"""The Kneser-Ney model against a plain version, and what the classifier keeps."""

import math
import random
from collections import Counter, defaultdict

import pytest

from ledgersieve.llm import quality
from ledgersieve.llm.quality import ORDER, classify_quality, count_grams, kneser_ney, perplexities

START = "\x02" * (ORDER - 1)


def plain_model(texts):
    """Probability of a character after the three before it, from the definition."""
    levels = [Counter(), *[None] * (ORDER - 1)]
    for text in texts:
        line = START + text
        levels[0].update(line[i - ORDER + 1 : i + 1] for i in range(len(START), len(line)))
    for number in range(1, ORDER):
        levels[number] = Counter(gram[1:] for gram in levels[number - 1])
    tables = []
    for counts in levels:
        n = [sum(1 for c in counts.values() if c == i) for i in (1, 2, 3, 4)]
        cuts = [0.5] * 3
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            cuts = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 0.0]
            cuts = [min(max(d, 0.05), i - 0.05) for i, d in enumerate(cuts, 1)]
        contexts = defaultdict(list)
        for gram, count in counts.items():
            contexts[gram[:-1]].append((gram[-1], count))
        table = {}
        for context, after in contexts.items():
            total = sum(c for _, c in after)
            given = sum(cuts[min(c, 3) - 1] for _, c in after)
            table[context] = {w: (c - cuts[min(c, 3) - 1]) / total for w, c in after}, given / total
        tables.append(table)
    kinds = len(levels[-1]) + 1

    def probability(context, letter):
        if len(context) == 0:
            own, weight = tables[ORDER - 1][""]
            return own.get(letter, 0.0) + weight / kinds
        found = tables[ORDER - 1 - len(context)].get(context)
        below = probability(context[1:], letter)
        return below if found is None else found[0].get(letter, 0.0) + found[1] * below

    return probability


def test_perplexity_follows_the_definition(spark, docs_of):
    rng = random.Random(1)
    syllables = ["the", "an", "re", "on", "é", "ß", "日本", " ", ". "]
    write = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    trained = [write(80) for _ in range(60)]
    scored = [write(50) for _ in range(30)] + ["ZZZ!! the 😀𝕏 an", "the", "q" * 40, "", None]
    model = kneser_ney(count_grams(docs_of(list(enumerate(trained)))))
    found = {r.doc_id: r for r in perplexities(docs_of(list(enumerate(scored))), model, shards=3).collect()}
    probability = plain_model(trained)
    assert len(found) == len(scored)
    for doc_id, text in enumerate(scored):
        line = START + "".join(c if ord(c) < 0xFFFF else "￿" for c in text or "")
        logs = [math.log(probability(line[i - ORDER + 1 : i], line[i])) for i in range(len(START), len(line))]
        assert found[doc_id].n == len(logs)
        assert found[doc_id].log_sum == pytest.approx(sum(logs), rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def judged(spark, docs_of):
    rng = random.Random(2)
    words = ["".join(rng.choice(["the", "an", "re", "on", "ti"]) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    good = lambda: " ".join(rng.choice(words) for _ in range(60))
    junk = lambda: " ".join(rng.choice(words).upper() + "!!" for _ in range(60))
    rows = [(i, good() if i % 5 else junk(), "en" if i % 3 else "de") for i in range(600)]
    rows += [(600, None, "en"), (601, "", None), (602, good(), None), (603, good(), "xx"), (None, good(), "en"), (1, rows[1][1], "de")]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 600, 2)] + [(None, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of([(*r, "s") for r in rows])
    return docs, labels, classify_quality(docs, labels).collect()


def test_held_out_accuracy(judged):
    held_out = [r for r in judged[2] if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 2]
    assert all(not r.keep for r in held_out if r.doc_id % 5 == 0)
    kept = [r.keep for r in held_out if r.doc_id % 5]
    assert sum(kept) >= 0.93 * len(kept)


def test_odd_rows_are_judged(judged):
    by_id = {(r.doc_id, r.lang): r for r in judged[2]}
    assert len(judged[2]) == 606
    assert (by_id[600, "en"].keep, by_id[600, "en"].perplexity) == (False, None) and not by_id[601, None].keep
    assert by_id[602, None].threshold and by_id[603, "xx"].threshold
    assert by_id[None, "en"].perplexity > 1


def test_without_trusted_text_all_text_stays(judged, docs_of):
    docs, labels, _ = judged
    found = classify_quality(docs, labels.filter("false")).collect()
    assert {r.keep for r in found if r.n} == {True} and len(found) == 606
    assert classify_quality(docs_of([]), labels).collect() == []


def test_thresholds_reject_low_text_near_the_trusted(spark, docs_of):
    """Low text of one repeated word reads better than the worst of the trusted, which a quantile of 0.99 lets pass."""
    rng = random.Random(9)
    words = ["".join(rng.choice(["the", "an", "re", "on", "ti"]) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    good = lambda i: " ".join(rng.choice(words) for _ in range(60)) if i % 60 != 15 else "".join(rng.choice("xyzw0189.") for _ in range(28))
    junk = lambda: " ".join(["thereQ"] * rng.randint(20, 60))
    rows = [(i, good(i) if i % 4 else junk(), "en" if i % 40 else "de", "s") for i in range(1, 3000)]
    rows += [(3000 + i, good(i), "fr", "s") for i in range(1, 20)] + [(4000, good(1), "unlabelled", "s")]
    low = lambda i: i % 4 == 0
    labels = [(i, int(not low(i)), 0) for i, *_ in rows if i % 3 == 0 or 3000 < i < 4000]
    found = {r.doc_id: r for r in classify_quality(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    judged = [i for i in found if i < 3000]
    assert sum(not found[i].keep for i in judged if low(i)) >= 0.95 * sum(map(low, judged))
    fine = [i for i in judged if not low(i) and i % 60 != 15]
    assert sum(found[i].keep for i in fine) >= 0.93 * len(fine)
    assert found[3001].threshold == found[4000].threshold  # too few texts for a quantile of its own


def test_model_counts_all_trusted_documents_of_its_half(spark, monkeypatch):
    n, counted = 18_000, []
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")

    def count(texts):
        counted.append(texts.count())
        return count_grams(texts)

    monkeypatch.setattr("ledgersieve.llm.quality.count_grams", count)
    most = [quality._SENT_IDS, 10]  # beyond as many, ids are joined by a shuffle
    for limit in most:
        monkeypatch.setattr(quality, "_SENT_IDS", limit)
        classify_quality(docs, labels)
    half = docs.filter("xxhash64(doc_id) % 2 = 0").count()
    assert half > 8_192
    assert counted == [half, half]
