"""Main text of web pages: page structure, and differencing against the pages with the nearest URLs.

Each page is cut into lines once. Menus, forms, scripts and the like are left out by their markup. Differencing
then judges every page: within a host, pages are put in the order of their URL paths, and a page is paired with
the nearest ones that are no copies of it, since a copy shares the article as well. The lines of both are aligned
by longest common subsequence; shared lines are what the site repeats, so they go. A check by markup follows on
pages that have an article (or main) element: shared lines inside it come back, since two articles may hold the
same line, and lines outside it that the page alone has go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .texts import slices, stored

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "head title script style noscript template nav footer aside form button select textarea dialog iframe object svg "
    "canvas audio video menu math".split()
)
_MAIN = frozenset(("article", "main"))
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
_ALIKE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
_SILENT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banners?|sponsor(?:ed|s)?|promos?|menus?|nav|navbar|navigation|breadcrumbs?|"
    r"sidebars?|widgets?|cookies?|consent|notices?|popups?|modals?|newsletter|subscribe|"
    r"signup|login|comments?|respond|disqus|related|share|social|pagination|pager|skip)\d*(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Within an article only an element with just such a name is none of its parts.
_SILENT_IN_MAIN = frozenset(
    "ad ads advert adverts advertisement advertisements banner sponsor sponsored promo menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar widget cookie cookies cookie-notice cookie-banner consent notice notices popup modal newsletter "
    "subscribe signup login comment comments respond disqus".split()
)
#: Within an article these are parts of it, such as an "entry-header" with the title.
_FRAME_NAMES = re.compile(r"(?:^|[\s_-])(?:header|masthead|footer)(?:$|[\s_-])", re.IGNORECASE)
#: Where a name such as "cookieBanner" goes on with another word.
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SILENT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


class Line(NamedTuple):
    """One block of a page's text, and whether markup places it in the main element."""

    text: str
    main: bool


class _Open(NamedTuple):
    """An open element; what holds for one holds for those inside."""

    name: str
    silent: bool
    main: bool


_OUTSIDE = _Open("", False, False)


class PageLines(HTMLParser):
    """Cuts a page into lines at block elements; what silent elements hold is left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self._open: list[_Open] = []
        self._held: list[str] = []

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    @classmethod
    def of(cls, html: str) -> list[Line]:
        parser = cls()
        parser.feed(html)
        rest = parser.rawdata
        parser.close_page(rest)
        return parser.lines

    def close_page(self, rest: str) -> None:
        """Ends a page that may be cut off: a tag that never ends is markup, other text counts."""
        if rest and not rest.startswith("<"):
            self.handle_data(unescape(rest.split("<")[0]))
        self._flush()

    def _flush(self) -> None:
        if not self._held:
            return
        text = " ".join("".join(self._held).split())
        self._held = []
        if text:
            self.lines.append(Line(text, bool(self._open) and self._open[-1].main))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE:
            self._flush()
            if tag in _CLOSES_P:
                self._close_within("p", ("article", "div", "section", "td", "li", "blockquote"))
            if tag in _ALIKE:
                names = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                for name in names:
                    self._close_within(name, _ALIKE[tag])
        if tag in _VOID:
            return
        outer = self._open[-1] if self._open else _OUTSIDE
        silent = outer.silent or tag in _SILENT or tag == "header" and not outer.main
        main = outer.main or tag in _MAIN
        if attrs and not silent:
            named = {key: value or "" for key, value in attrs}
            role = named.get("role", "").lower()
            silent, main = role in _SILENT_ROLES, main or role == "main"
            if not silent and ("class" in named or "id" in named) and tag not in ("html", "body", *_MAIN):
                names = _HUMP.sub("-", f"{named.get('class', '')} {named.get('id', '')}")
                if outer.main:
                    silent = not _SILENT_IN_MAIN.isdisjoint(names.lower().split())
                else:
                    silent = bool(_SILENT_NAMES.search(names) or _FRAME_NAMES.search(names))
        self._open.append(_Open(tag, silent, main))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE:
            self._flush()
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at].name == tag:
                del self._open[at:]
                return
            if tag in _INLINE and self._open[at].name not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not (self._open and self._open[-1].silent):
            self._held.append(data)

    def _close_within(self, name: str, walls: tuple[str, ...]) -> None:
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at].name == name:
                del self._open[at:]
                return
            if self._open[at].name in walls:
                return


def page_place(url: str | None) -> tuple[str | None, str]:
    """Host and path of a URL; no host for what is none."""
    try:
        parts = urlsplit((url or "").strip())
        return (parts.hostname or None), parts.path
    except ValueError:
        return None, ""


def shared_lines(one: list[int], other: list[int]) -> list[int]:
    """Numbers of the lines of ``one`` that a longest common subsequence with ``other`` holds.

    Bit-parallel: a row per line, as a whole number with a bit per line of the other page.
    """
    start = 0
    while start < min(len(one), len(other)) and one[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(one), len(other)) - start and one[-1 - end] == other[-1 - end]:
        end += 1
    left, right = one[start : len(one) - end], other[start : len(other) - end]
    at: dict[int, int] = {}
    for place, value in enumerate(right):
        at[value] = at.get(value, 0) | 1 << place
    full = (1 << len(right)) - 1
    rows, row = [], full
    for value in left:
        hit = row & at.get(value, 0)
        row = (row + hit | row - hit) & full
        rows.append(row)
    found, place, number = [], len(right), len(left)
    # A zero bit marks a column where the common length grows by one.
    while number and place:
        length = place - (rows[number - 1] & (1 << place) - 1).bit_count()
        above = place - ((rows[number - 2] if number > 1 else full) & (1 << place) - 1).bit_count()
        if above == length:
            number -= 1
        elif place - 1 - (rows[number - 1] & (1 << place - 1) - 1).bit_count() == length:
            place -= 1
        else:
            number, place = number - 1, place - 1
            found.append(start + number)
    return [*range(start), *reversed(found), *range(len(one) - end, len(one))]


def _common_start(one: str, other: str) -> int:
    for place, (a, b) in enumerate(zip(one, other, strict=False)):
        if a != b:
            return place
    return min(len(one), len(other))


#: A page that shares so much of another's text is a copy of it.
_COPY_SHARE = 0.9
#: Pages on each side among which those to compare with are chosen, and how many are.
_REACH, _PAIRS = 8, 2
_LINED = "id long, hash long, url string, host string, path string, lines array<string>, inside array<boolean>, digests array<long>"


def page_lines(pages: DataFrame) -> DataFrame:
    """id, hash of the whole row, url, host, path, and of each line its text, whether it is inside a main element, and a digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "html"):
                places = [page_place(u) for u in rows.column("url").to_pylist()]
                pages = [PageLines.of(html or "") for html in rows.column("html").to_pylist()]
                texts = [[line.text for line in lines] for lines in pages]
                inside = [[line.main for line in lines] for lines in pages]
                digests = [[xxhash.xxh64_intdigest(line.text.encode("utf-8", "surrogatepass")) - (1 << 63) for line in lines] for lines in pages]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"), rows.column("hash"), rows.column("url"), pa.array([h for h, _ in places], pa.string()),
                        pa.array([p for _, p in places], pa.string()), pa.array(texts, pa.list_(pa.string())),
                        pa.array(inside, pa.list_(pa.bool_())), pa.array(digests, pa.list_(pa.int64())),
                    ],
                    ["id", "hash", "url", "host", "path", "lines", "inside", "digests"],
                )

    keyed = pages.select(F.col("page_id").cast("long").alias("id"), F.xxhash64("page_id", "url", "html").alias("hash"), "url", "html")
    return keyed.mapInArrow(cut, _LINED)


def repeated_lines(lined: DataFrame, chunk_pages: int = 2_000) -> DataFrame:
    """For each page that has a host, the numbers of the lines it shares with pages of near URLs: id, hash, shared.

    ``lined`` is a frame of ``page_lines``; repeated rows are one page. Pages get their place in the order of
    host, path, id and hash by a range sort; a chunk of consecutive pages is compared in one task together with
    some before and after it, so that a host of any size is spread and every page has all its neighbours.
    """
    # Texts stay where they are: only digests and lengths are shuffled.
    lengths = F.transform("lines", lambda line: F.length(line)).alias("lengths")
    narrow = stored(lined.filter("host IS NOT NULL").select("id", "hash", "host", "path", "digests", lengths), "page_lines")
    narrow = narrow.dropDuplicates(["id", "hash"])
    order = ["host", "path", "id", "hash"]
    ranged = stored(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "pages"
    ).withColumn("part", F.shiftright("at", 33))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("first"))
    numbered = ranged.join(firsts, "part").withColumn("number", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at", "first")
    edges = F.array_distinct(F.array(*[F.floor((F.col("number") + step) / chunk_pages) for step in (-_REACH, 0, _REACH)]))
    chunked = numbered.withColumn("chunk", F.explode(edges))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", ignore_index=True)
        hosts, paths, lines = rows["host"].tolist(), rows["path"].tolist(), [x.tolist() for x in rows["digests"]]
        own = np.flatnonzero(rows["number"] // chunk_pages == key[0])
        shared = []
        for at in own:
            near = [
                (-_common_start(paths[at], paths[other]), abs(other - at), other)
                for other in range(max(0, at - _REACH), min(len(rows), at + _REACH + 1))
                if other != at and hosts[other] == hosts[at]
            ]
            shared.append(lines_to_drop(lines[at], rows["lengths"].iloc[at], (lines[other] for _, _, other in sorted(near))))
        return pd.DataFrame({"id": rows["id"].iloc[own], "hash": rows["hash"].iloc[own], "shared": pd.Series(shared, dtype=object).array})

    return chunked.groupBy("chunk").applyInPandas(compare, "id long, hash long, shared array<int>")


def lines_to_drop(own: list[int], lengths: list[int], others: Iterator[list[int]]) -> list[int]:
    """Numbers of the lines shared with the first pages of ``others`` that are no copies; none if all are."""
    gone: set[int] = set()
    pairs, whole = 0, sum(lengths)
    for other in others:
        common = shared_lines(own, other)
        if sum(lengths[n] for n in common) >= _COPY_SHARE * whole:
            continue
        gone.update(common)
        pairs += 1
        if pairs == _PAIRS:
            break
    return sorted(gone)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of the main text of whole pages.

    ``pages`` needs page_id, url and html; further columns are ignored. White space inside a block
    becomes one space, and blocks are joined by one space. A null or empty page has an empty text; a
    page that is cut off counts as far as it goes. Pages lose the lines they share with the two nearest
    pages of their host that are no copies: a page that shares nine tenths of the text is one. On pages with a
    main element its shared lines come back, and other lines outside it go. Pages with a null or broken URL
    have no pair, so only their markup is judged, and so have those that have only copies near them. Repeated
    rows come back as often as given.
    """
    # Pages are parsed once for the digests and once for the texts: storing the texts in between takes more disk than the input has.
    lined = page_lines(pages)
    shared = repeated_lines(lined).select(F.col("id").alias("of"), F.col("hash").alias("of_hash"), "shared")
    marked = F.array_contains("inside", True)

    def kept(_, number):
        own = ~F.coalesce(F.array_contains("shared", number), F.lit(False))
        inside = F.get("inside", number)
        return (own | inside) & (inside | ~marked)

    judged = lined.select("id", "hash", "url", "lines", "inside").join(shared, F.col("id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash")), "left")
    text = F.array_join(F.filter("lines", kept), " ").alias("text")
    return judged.select(F.col("id").alias("page_id"), "url", text).withColumn("n_chars", F.length("text").cast("long"))
