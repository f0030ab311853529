"""License scans and main text of pages."""

import html
import random
import re
import textwrap
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgersieve.llm.licenses import TEMPLATES, LicenseMatcher, candidate_blocks, scan_licenses
from ledgersieve.llm.pages import (
    PageLines, extract_main_text, lines_to_drop, page_lines, page_place, repeated_lines, shared_lines,
)

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def matcher():
    return LicenseMatcher()


def test_each_wording_names_its_license(matcher):
    for name, wordings in TEMPLATES.items():
        for wording in wordings:
            for text in (wording, wording.upper(), wording.replace(" ", "\n  ")):
                (found,) = matcher.match(text)
                assert (found["license"], found["confirmed"], found["missing"]) == (name, True, [])
                saved = {number: save for save, number in matcher.rank(text)}
                own = [number for number, (n, _) in enumerate(matcher.wordings) if n == name]
                assert max(saved[n] for n in own) == max(saved.values())


def test_scan_finds_each_wording_as_the_only_notice(spark, docs_of):
    wordings = [(name, wording) for name, own in TEMPLATES.items() for wording in own]
    rows = [(i, f"Some prose.\n{wording}\nMore prose.") for i, (_, wording) in enumerate(wordings)]
    found = {(r.doc_id, r.license) for r in scan_licenses(docs_of(rows)).collect() if r.confirmed}
    assert found == {(i, name) for i, (name, _) in enumerate(wordings)}


def test_wording_differences_are_exact(matcher):
    (found,) = matcher.match("Licensed under the Apache License, Version 1.1.")
    assert (found["confirmed"], found["missing"]) == (False, ["2.0"])
    (found,) = matcher.match("This work was licensed under the GNU General Public License, version 3, or later.")
    assert (found["license"], found["missing"], found["added"]) == ("GPL-3.0", ["is"], ["was"])
    both = matcher.match("Copyright 2020 X. All rights reserved.\nReleased under the MIT License.")
    assert {f["license"] for f in both if f["confirmed"]} == {"MIT", "All-rights-reserved"}


def test_words_far_apart_are_no_notice(matcher):
    prose = "Here all users of the library hold some rights under the licence terms, and the front seats stay reserved for guests."
    assert not any(f["confirmed"] for f in matcher.match(prose))
    inside = "All users of the library. Released under the MIT License. They hold rights, and seats stay reserved."
    assert [f["license"] for f in matcher.match(inside) if f["confirmed"]] == ["MIT"]


def test_notices_in_long_lines_are_found(matcher):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice(["the", "an", "re", "on", "ti", "license"]) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    for name, wordings in TEMPLATES.items():
        for wording in wordings:
            prose = rng.choices(vocabulary, k=6_000)
            at = rng.randint(0, len(prose))
            found = matcher.match(" ".join([*prose[:at], wording, *prose[at:]]))
            assert [f["license"] for f in found if f["confirmed"]] == [name]


def _prose(rng, count):
    return " ".join("".join(rng.choice(["the", "an", "re", "on", "ti"]) for _ in range(rng.randint(1, 3))) for _ in range(count))


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "-- "])
def test_wrapped_notices_are_found_at_every_width(matcher, mark):
    rng = random.Random(5)
    for width in (30, 40, 50, 60, 72, 80, 100):
        for name, wordings in TEMPLATES.items():
            for wording in wordings:
                wrapped = textwrap.wrap(wording, width, break_on_hyphens=False, break_long_words=False)
                text = "\n".join(mark + line for line in [*textwrap.wrap(_prose(rng, 60), width), *wrapped, *textwrap.wrap(_prose(rng, 60), width)])
                ((begin, end, found),) = matcher.notices(text)
                assert (found["license"], found["missing"], found["added"]) == (name, [], [])
                inside = re.findall(r"\w+", text[begin:end])
                assert [w for w in re.findall(r"\w+", wording)] == inside


def test_notices_are_those_that_stand_there(matcher):
    """Wordings with lost and added words, in texts put together at random; found are just those, in order."""
    rng = random.Random(6)
    for _ in range(60):
        parts, expected = [_prose(rng, rng.randint(0, 40))], []
        for _ in range(rng.randint(1, 6)):
            number = rng.randrange(len(matcher.wordings))
            name, wording = matcher.wordings[number]
            words = wording.split()
            if len(words) >= 40:
                for _ in range(2):
                    at = rng.randrange(1, len(words) - 1)
                    if not any(c.isdigit() for c in words[at]):
                        del words[at]
                words.insert(rng.randrange(1, len(words) - 1), "hereby")
            expected.append(name)
            parts += [" ".join(words), _prose(rng, rng.randint(8, 300))]
        text = rng.choice(["\n", " ", "\n\n"]).join(parts)
        assert [found["license"] for _, _, found in matcher.notices(text)] == expected


def test_sliding_every_wording_over_a_text(matcher):
    """Wherever all words of a wording stand in a row, a notice is found there or over it."""
    rng = random.Random(7)
    pieces = [w for _, wording in matcher.wordings for w in (wording, " ".join(wording.split()[:4]), " ".join(wording.split()[-5:]))]
    for _ in range(40):
        text = " ".join(rng.choice(pieces) if rng.random() < 0.4 else _prose(rng, rng.randint(1, 9)) for _ in range(25))
        words = list(re.finditer(r"[^\W_]+(?:[.'-][^\W_]+)*", text))
        lowered = [w.group().lower() for w in words]
        found = matcher.notices(text)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
        for wanted in matcher.words:
            for at in range(len(lowered) - len(wanted) + 1):
                if lowered[at : at + len(wanted)] == wanted:
                    begin, end = words[at].start(), words[at + len(wanted) - 1].end()
                    assert any(a < end and begin < b for a, b, _ in found)


def test_many_notices_take_time_in_proportion(matcher):
    wordings = [wording for _, wording in matcher.wordings]
    took = []
    for count in (250, 1_000):
        text = "\n".join(wordings[i % len(wordings)] for i in range(count))
        begin = time.process_time()
        assert len(matcher.notices(text)) == count
        took.append(time.process_time() - begin)
    assert took[1] < 8 * took[0]


def test_templates_of_the_caller_need_no_common_cue(spark, docs_of):
    own = {"House-1": ("You may share these pages with anybody who asks for them kindly.",), "House-2": ("Ask the owners.",)}
    rows = [(1, "x\nYou may share these pages\nwith anybody who asks for them kindly.\ny"), (2, "Nothing here."), (3, "Please ask the owners. Thanks.")]
    found = [(r.doc_id, r.line, r.n_lines, r.license, r.confirmed) for r in scan_licenses(docs_of(rows), own).collect()]
    assert sorted(found) == [(1, 1, 2, "House-1", True), (3, 0, 1, "House-2", True)]
    with pytest.raises(ValueError):
        scan_licenses(docs_of(rows), {})


def test_scan_of_whole_texts(spark, docs_of):
    far = "word " * 50_000
    rows = [
        (1, f"{far}\nLicensed under CC BY-NC 4.0.\n{far}"), (2, "nothing here"), (3, None), (4, ""), (None, "All rights reserved."),
        (5, "All rights reserved."), (5, "All rights reserved."), (6, "a licence to sing"), (7, "Released under the\nMIT License.\n\n\n\n\n\n©"),
    ]
    found = [(r.doc_id, r.line, r.license, r.confirmed) for r in scan_licenses(docs_of(rows)).collect()]
    assert sorted((f for f in found if f[3]), key=str) == sorted([
        (1, 1, "CC-BY-NC-4.0", True), (None, 0, "All-rights-reserved", True), (5, 0, "All-rights-reserved", True),
        (5, 0, "All-rights-reserved", True), (7, 0, "MIT", True),
    ], key=str)
    assert {f[0] for f in found if not f[3]} <= {6, 7}
    assert scan_licenses(docs_of([])).collect() == []
    assert candidate_blocks(["a", "license", "b", "c", "warranty", "d"]) == [(1, 4)]


def plain_common(one, other):
    table = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
    for i, a in enumerate(one):
        for j, b in enumerate(other):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(2000):
        one, other = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found, rest = shared_lines(one, other), iter(other)
        assert len(found) == plain_common(one, other) and found == sorted(set(found))
        assert all(any(one[i] == y for y in rest) for i in found)


@pytest.mark.parametrize("page,lines", [
    ("<article>a &copy; b &#x41;&lt;i&gt;<div class=\"ad\">n</div>c", ["a © b A<i>", "c"]),
    ("<article><p>x<b>y</b>z<br>w<p>q</article", ["xyz", "w", "q"]),
    ("<article>t<section class='comments'><p>no</section>u<script>if(a<b)</script>v</article>", ["t", "u", "v"]),
    ("<article><header class='entry-header'><h1>T</h1></header>x</article><footer>f</footer>", ["T", "x"]),
    ("<header>h</header><nav>n</nav><aside>s</aside><form>f</form><div id=cookie-notice>c</div><p>p", ["p"]),
    ("<div class='cookieBanner'>c</div><div id=advert2>a</div><article><p hidden>h</p><div class='adage'>b</div></article>", ["h", "b"]),
    ("<article>a<!-- b --> c <style>p{}</style>d</article>", ["a c", "d"]),
    ("<ul><li>a<li>b</ul>c &am", ["a", "b", "c &am"]), ("<p>a <", ["a"]), ("", []), ("<script>x", []),
])
def test_lines_of_a_page(page, lines):
    assert [line.text for line in PageLines.of(page)] == lines


@pytest.mark.parametrize("page,lines", [
    ("<article>a<section class='related'>b</section><div id='comments-on-physics'>c</div><p class='share'>d</article>", ["a", "b", "c", "d"]),
    ("<article>a<div class='box comments'>b</div><div id='ad'>c</div><p class='notice'>d</p><aside>e</aside></article>", ["a"]),
    ("<div class='related'>a</div><div id='comments-on-physics'>b</div><p>c", ["c"]),
])
def test_names_count_less_within_an_article(page, lines):
    assert [line.text for line in PageLines.of(page)] == lines


def test_copies_are_no_pair():
    site, text, other = [1, 2], [11, 12, 13], [21, 22]
    lengths = [5, 5, 100, 100, 100, 5]
    page = [*site, *text, 9]
    assert lines_to_drop(page, lengths, iter([page, page])) == []
    assert lines_to_drop(page, lengths, iter([page, [*site, 11, 12, 13, 8], [*site, *other, 9]])) == [0, 1, 5]
    assert lines_to_drop(page, lengths, iter([[1, 31], [2, 32], page[:4]])) == [0, 1]
    assert lines_to_drop([], [], iter([[], [1]])) == []


def _words(text):
    return Counter(text.split())


def _quality(spark, pages, change):
    """Precision and recall of the words of pages whose markup was changed, against what their articles hold."""
    truth = {r.page_id: _words(r.text) for r in extract_main_text(pages).collect()}
    changed = pages.withColumn("html", change(F.col("html")))
    found = {r.page_id: _words(r.text) for r in extract_main_text(changed).collect()}
    common = sum((found[i] & truth[i]).total() for i in truth)
    return common / sum(w.total() for w in found.values()), common / sum(w.total() for w in truth.values())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")
def test_given_pages_without_their_article_tags(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    plain = lambda html: F.regexp_replace(html, "</?(article|main)>", "")
    precision, recall = _quality(spark, pages, plain)
    assert precision > 0.99 and recall > 0.99
    # Nothing but a repeated frame of lines around the text.
    frame = "".join(f"<div>Line {i} of the frame</div>" for i in range(30))
    framed = lambda html: F.concat(F.lit(frame), F.regexp_replace(plain(html), "(?s)^.*?(?=<h1>)", ""), F.lit(frame))
    precision, recall = _quality(spark, pages, framed)
    assert precision > 0.95 and recall > 0.95


def test_place_of_a_url():
    assert page_place("HTTP://user@Host.example:80/a/b?q#f") == ("host.example", "/a/b")
    assert page_place(None) == (None, "") and page_place("http://[") == (None, "") and page_place("/a") == (None, "/a")


def test_differencing_and_markup_together(spark):
    site = lambda i, body: f"<html><body><div>Site name</div><div>Menu of the site</div>{body}<div>Imprint</div>{html.escape('<&>')}</body></html>"
    rows = [(i, f"http://a.example/x/{i}", site(i, f"<p>own text {i}</p>")) for i in range(40)]
    rows += [(100 + i, f"http://b.example/{i}", site(i, "<article><p>copied article</p></article>")) for i in range(5)]
    rows += [(200, None, "<p>no url</p>"), (201, "http://c.example/", "<p>alone</p>"), (202, "http://c.example/2", None), (203, "%%", ""), (None, "http://a.example/x/1", "<p>nameless</p>")]
    rows += [(300, "http://d.example/p", "<p>twice</p>")] * 2
    rows += [(400 + i, f"http://e.example/{i}", site(i, "<p>" + "a copied article " * 60 + "</p>")) for i in range(4)]
    rows += [(410 + i, f"http://e.example/x{i}", site(i, f"<p>{f'another text {i} ' * 60}</p>")) for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS lines", "'t' AS text").repartition(4)
    found = {}
    for r in extract_main_text(pages).collect():
        assert r.n_chars == len(r.text)
        found.setdefault(r.page_id, []).append(r.text)
    assert all(found[i] == [f"own text {i}"] for i in range(40))
    assert all(found[100 + i] == ["copied article"] for i in range(5))
    assert (found[200], found[201], found[202], found[203], found[None]) == (["no url"], ["alone"], [""], [""], ["nameless"])
    assert found[300] == ["twice"] * 2
    assert all(found[400 + i] == [("a copied article " * 60).strip()] for i in range(4))
    assert all(found[410 + i] == [(f"another text {i} " * 60).strip()] for i in range(2))
    assert extract_main_text(pages.filter("false")).collect() == []


def test_differencing_judges_pages_with_an_article_too(spark):
    page = "<div>{0} list</div><article><p>Same opening.</p><p>Body {0} of its own.</p></article><div>One frame</div>"
    rows = [(n, f"https://a.example/news/{n}", page.format(n)) for n in range(4)]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")
    found = repeated_lines(page_lines(pages)).collect()
    assert sorted((r.id, tuple(r.shared)) for r in found) == [(n, (1, 3)) for n in range(4)]
    # The check by markup follows: a line that two articles share is text, one outside an article is none.
    texts = sorted((r.page_id, r.text) for r in extract_main_text(pages).collect())
    assert texts == sorted((n, f"Same opening. Body {n} of its own.") for n in (0, 0, 1, 2, 3))
