"""Mixing: targets, exact budgets, repeatability."""

from collections import defaultdict

from ledgersieve.llm.mixing import mix_sources


def mixed(docs, **options):
    return [r.asDict() for r in mix_sources(docs, **options).collect()]


def test_budgets_are_met_exactly_and_the_hot_source_is_split(docs_of):
    rows = [(i, "w " * (i % 50 + 1), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    found = mixed(docs_of(rows), bucket_rows=100)
    assert len(found) == 3000
    total, by_source = sum(r["size"] for r in found), defaultdict(list)
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[r["source"]].append(r)
    for group in by_source.values():
        assert sum(r["size"] for r in group) == group[0]["source_size"]
        assert sum(r["taken"] for r in group) == group[0]["budget"]
        assert abs(group[0]["budget"] - group[0]["target"]) <= 0.5 and group[0]["target"] <= 2 * group[0]["source_size"]
    assert abs(sum(g[0]["target"] for g in by_source.values()) - 1.5 * total) < 1e-6 * total
    open_ = [s for s, g in by_source.items() if g[0]["target"] < 2 * g[0]["source_size"]]
    weight = dict(zip(sorted(by_source), (3, 1, 2, 3, 1, 2), strict=False))
    assert len({round(by_source[s][0]["target"] / weight[s], 6) for s in open_}) == 1
    again = mixed(docs_of(rows, parts=7), bucket_rows=10_000)
    key = lambda r: (r["doc_id"], r["taken"], r["target"])
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_odd_rows(docs_of):
    rows = [
        (1, "a b\tc\x0bd", "en", "b"), (2, None, "en", "b"), (3, "", "en", None), (4, "a\xa0b c", "en", None),
        (None, "x y z", "en", "a"), (1, "a b\tc\x0bd", "en", "b"), (5, "q " * 100_000, "en", "\U0001f600"),
    ]
    found = mixed(docs_of(rows))
    assert sorted((r["doc_id"] or 0, r["size"]) for r in found) == [(0, 3), (1, 4), (1, 4), (2, 0), (3, 0), (4, 2), (5, 100_000)]
    assert {r["source"] for r in found} == {"a", "b", None, "\U0001f600"}


def test_nothing_to_mix(docs_of):
    assert mixed(docs_of([]).filter("false")) == []
    assert [(r["taken"], r["target"]) for r in mixed(docs_of([(1, " "), (2, None)]))] == [(0, 0.0), (0, 0.0)]
