"""License scans by conditional compression.

A stretch of text that may hold a license notice is compressed alone, and again with each template as a
raw zstandard dictionary. Templates are ranked by how much smaller the text gets: what a template
already says costs almost nothing. The ranking finds the closest template among many alike, however
the wording is wrapped or filled in; every wording is then compared word by word, and the differing
words are given. Stretches are windows of words around cues, as wide as the longest wording needs on both
sides, so lines, comment marks and what stands around a notice do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .texts import slices

# Words of a cue may stand on two lines, with comment marks between them.
_CUE = (
    r"licen[sc]|copyright|copyleft|warrant|permission\W{1,9}is\W{1,9}hereby|rights\W{1,9}reserved|redistribut|public\W{1,9}domain|spdx|"
    r"\bcc\W{0,9}by|\bcc\W{0,9}(?:0|zero)|creative\W{1,9}commons|\bgpl|©"
)
_CUES = re.compile(_CUE, re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
#: Lines without a cue that a block may span.
_GAP = 3
#: Words of a block that are compared at once.
_PIECE = 4_096
#: Words by which a wording without a cue is looked for.
_OWN_CUES = 3
_COMMENT_MARKS = re.compile(r"\n[ \t]*(?://+|#+|\*+|--+|;+|>+)[ \t]*")

#: Fixed wordings of public licenses: name, and the notices that stand for it.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."),
    "All-rights-reserved": ("All rights reserved.",),
}


def candidate_blocks(lines: list[str], cues: re.Pattern = _CUES) -> list[tuple[int, int]]:
    """Runs of lines that start and end with a cue and have at most a few lines without one between: first and last line."""
    blocks: list[list[int]] = []
    for number in (number for number, line in enumerate(lines) if cues.search(line)):
        if blocks and number - blocks[-1][1] <= _GAP + 1:
            blocks[-1][1] = number
        else:
            blocks.append([number, number])
    return [(first, last) for first, last in blocks]


def cue_pattern(templates: dict[str, tuple[str, ...]]) -> str:
    """What a text with one of the wordings holds: the common cues, and the longest words of wordings without any."""
    words: set[str] = set()
    for wordings in templates.values():
        for wording in wordings:
            if not _CUES.search(wording):
                own = {w.lower() for w in _WORD.findall(wording)}
                words.update(sorted(own, key=lambda w: (-len(w), w))[:_OWN_CUES])
    return "|".join([_CUE, *(re.escape(word) for word in sorted(words))])


class LicenseMatcher:
    """Ranks templates by conditional compression and confirms the winners."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, level: int = 9):
        self.wordings = [(name, wording) for name, wordings in templates.items() for wording in wordings]
        self.words = [[w.lower() for w in _WORD.findall(wording)] for _, wording in self.wordings]
        self.cues = re.compile(cue_pattern(templates), re.IGNORECASE)
        self.longest = max(map(len, self.words), default=0)
        self.alone = zstandard.ZstdCompressor(level=level)
        self.given = [
            zstandard.ZstdCompressor(
                level=level,
                dict_data=zstandard.ZstdCompressionDict(_plain(wording).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, wording in self.wordings
        ]

    def rank(self, block: str) -> list[tuple[int, int]]:
        """Bytes saved and number of each wording, most saved first."""
        data = _plain(block).encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(data))
        return sorted(((size - len(c.compress(data)), number) for number, c in enumerate(self.given)), key=lambda x: (-x[0], x[1]))

    def match(self, block: str, least_share: float = 0.9, nearest_ranks: int = 3) -> list[dict]:
        """The licenses of a text in order, or else the nearest one, unconfirmed.

        All wordings are compared by words, since prose around a notice says more about the ranks
        than the notice does. A wording is confirmed if few of its words are missing and few others stand
        in between, at most twice as many. Numbers of a wording must all be there: they tell versions
        apart. If none holds, the nearest of the first ``nearest_ranks`` is given.
        """
        found = [result for _, _, result in self.notices(block, least_share)]
        return found or [self.nearest(block, nearest_ranks)]

    def notices(self, text: str, least_share: float = 0.9) -> list[tuple[int, int, dict]]:
        """All confirmed notices in order: where they begin and end in the text, and the result.

        Each window begins at the first cue that is left, and is as wide as a notice with this cue can be and as
        much again. In it the wording wins that has most words there, less those that differ, ties by rank;
        what lies before and behind it is looked at again. A window without any is left for the next one.
        So the work grows with the text, however many notices or cues it has.
        """
        words = list(_WORD.finditer(text))
        starts = [w.start() for w in words]
        lowered = [w.group().lower() for w in words]
        cues = sorted({max(0, bisect_right(starts, m.start()) - 1) for m in self.cues.finditer(text)}) if words else []
        # A notice may be longer than its wording by the words that may be added.
        reach = int(self.longest * (1 + 2 * (1 - least_share))) + 1
        found: list[tuple[int, int, dict]] = []
        waiting = [(0, len(words))]
        while waiting:
            begin, end = waiting.pop()
            at = bisect_left(cues, begin)
            while at < len(cues) and cues[at] < end:
                first, last = max(begin, cues[at] - reach), min(end, cues[at] + 2 * reach)
                best = self._best(text[starts[first] : words[last - 1].end()], lowered[first:last], least_share)
                if best is None:
                    at = bisect_right(cues, cues[at] + reach)
                    continue
                result, span = best
                start, stop = first + span.start, first + span.stop
                found.append((starts[start], words[stop - 1].end(), result))
                waiting.append((first, start))
                begin, at = stop, bisect_left(cues, stop)
        return sorted(found, key=lambda notice: notice[:2])

    def _best(self, text: str, words: list[str], least_share: float) -> tuple[dict, slice] | None:
        there, best = Counter(words), None
        for saved, number in self.rank(text):
            wanted = self.words[number]
            if not wanted or sum(min(n, there[w]) for w, n in Counter(wanted).items()) < least_share * len(wanted):
                continue
            result, span = self._compared(number, saved, words)
            missing, added = result["missing"], result["added"]
            numbers = [w for w in missing if any(c.isdigit() for c in w)]
            enough = len(wanted) - len(missing) >= least_share * len(wanted)
            score = len(wanted) - 2 * len(missing) - len(added)
            if not numbers and enough and len(added) <= 2 * (1 - least_share) * len(wanted) + 1e-9 and (best is None or score > best[0]):
                best = score, result | {"confirmed": True}, span
        return best and best[1:]

    def nearest(self, block: str, nearest_ranks: int = 3) -> dict:
        """Of the first ranks the wording that differs least, unconfirmed."""
        words = [w.lower() for w in _WORD.findall(block)]
        results = [self._compared(number, saved, words)[0] for saved, number in self.rank(block)[:nearest_ranks]]
        return min(results, key=lambda r: len(r["missing"]) + len(r["added"]))

    def _compared(self, number: int, saved: int, words: list[str]) -> tuple[dict, slice]:
        missing, added, span = _differences(self.words[number], words)
        return {"license": self.wordings[number][0], "saved": saved, "missing": missing, "added": added, "confirmed": False}, span


def _plain(text: str) -> str:
    return " ".join(_COMMENT_MARKS.sub("\n", text).lower().split())


def _differences(wanted: list[str], words: list[str]) -> tuple[list[str], list[str], slice]:
    """Words of the wording that the block lacks, words the block has in between, and the span they lie in.

    The span is the one with the fewest such words. Long blocks are compared in pieces that overlap by
    twice the wording.
    """
    best: tuple[int, int, np.ndarray] | None = None
    step = max(_PIECE, 4 * len(wanted))
    for start in range(0, max(1, len(words)), step):
        costs = _span_costs(wanted, words[start : start + step + 2 * len(wanted)])
        least = int(costs[-1].min())
        if best is None or least < best[0]:
            best = least, start, costs
    _, start, costs = best
    row, column = len(wanted), int(costs[-1].argmin())
    stop, missing, added = start + column, [], []
    while row:
        cost = costs[row, column]
        if column and wanted[row - 1] == words[start + column - 1] and costs[row - 1, column - 1] == cost:
            row, column = row - 1, column - 1
        elif costs[row - 1, column] + 1 == cost:
            row -= 1
            missing.append(wanted[row])
        else:
            column -= 1
            added.append(words[start + column])
    return missing[::-1], added[::-1], slice(start + column, stop)


def _span_costs(wanted: list[str], words: list[str]) -> np.ndarray:
    """Missing and added words of each beginning of the wording in the best span that ends at each word."""
    known = {word: number for number, word in enumerate(dict.fromkeys(wanted))}
    codes = np.array([known.get(w, -1) for w in words], dtype=np.int32)
    costs = np.zeros((len(wanted) + 1, len(words) + 1), dtype=np.int32)
    places = np.arange(len(words) + 1, dtype=np.int32)
    for row, word in enumerate(wanted, 1):
        cost = costs[row - 1] + 1
        cost[1:] = np.where(codes == known[word], np.minimum(cost[1:], costs[row - 1, :-1]), cost[1:])
        costs[row] = np.minimum.accumulate(cost - places) + places
    return costs


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, least_share: float = 0.9) -> DataFrame:
    """License notices in whole texts: doc_id, line (from 0), n_lines, license, saved, missing, added, confirmed.

    ``saved``: bytes by which the template's dictionary shrinks the text around the notice; ``missing`` and
    ``added``: words of the template that are not there, and further words inside. Lines with cues that lie
    close together and belong to no notice come back once, unconfirmed, with the nearest license. ``docs``
    needs doc_id and text; further columns are ignored. Null and empty texts have no notices. Each row is
    scanned on its own, so null and repeated doc_ids and equal rows change nothing, and no row is shuffled.
    """
    if not templates:
        raise ValueError("no templates")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = LicenseMatcher(templates)
        for batch in batches:
            for rows in slices(batch, "text"):
                found = []
                for number, text in enumerate(rows.column("text").to_pylist()):
                    found += [{"row": number} | match for match in _matches(matcher, text, least_share)]
                table = pa.RecordBatch.from_pylist(found, _FOUND)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(table.column("row")), *table.columns[1:]], ["doc_id", *_FOUND.names[1:]]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", "text")
        .filter(F.col("text").rlike(f"(?iu){cue_pattern(templates)}"))
        .mapInArrow(
            scan,
            f"doc_id {kind}, line int, n_lines int, license string, saved int, missing array<string>, "
            "added array<string>, confirmed boolean",
        )
    )


def _matches(matcher: LicenseMatcher, text: str, least_share: float) -> Iterator[dict]:
    """The notices of a text, and the nearest license for each block of cues without one."""
    lines = text.split("\n")
    ends = np.cumsum([len(line) + 1 for line in lines])
    line_of = lambda place: int(np.searchsorted(ends, place, side="right"))
    spans: list[tuple[int, int]] = []
    for begin, end, match in matcher.notices(text, least_share):
        spans.append((line_of(begin), line_of(end - 1)))
        yield match | {"line": spans[-1][0], "n_lines": spans[-1][1] - spans[-1][0] + 1}
    firsts, lasts = [a for a, _ in spans], [b for _, b in spans]
    for first, last in candidate_blocks(lines, matcher.cues):
        # Notices are in order, so the block holds one if any that ends behind its first line begins before its last.
        at = bisect_left(lasts, first)
        if at == len(spans) or firsts[at] > last:
            block = "\n".join(lines[first : last + 1])
            yield matcher.nearest(block) | {"line": first, "n_lines": last + 1 - first}


_FOUND = pa.schema(
    [
        ("row", pa.int64()), ("line", pa.int32()), ("n_lines", pa.int32()), ("license", pa.string()), ("saved", pa.int32()),
        ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string())), ("confirmed", pa.bool_()),
    ]
)
