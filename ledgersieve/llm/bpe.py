"""Byte-level BPE by merge ranks, without merging: encoding in linear time, and decoding.

A piece of text is read from left to right. At each place the longest token that fits is tried
first (all matches of a piece come from one pass of an Aho-Corasick automaton over its bytes as
Latin-1). A token may follow another only if merging their bytes by rank would leave just these two;
such verdicts are remembered. If no token fits, the last one is given up for its next shorter
prefix, and its end is marked as a dead end, so that no end is tried twice. What is left at the end
is what merging by rank gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .texts import slices, space_chunks

_REMEMBERED = 300_000
#: Longer pieces and chunks are not remembered, so that what is stays within some 100 MB.
_LONGEST = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankEncoder:
    """Encodes and decodes by the ranks of single bytes and merged tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.parts = {rank: self._last_merge(token) for token, rank in ranks.items()}
        self.pairs = {pair: rank for rank, pair in self.parts.items() if pair}
        # Tokens that merging never makes are only found as whole pieces.
        made = [token for token, rank in ranks.items() if len(token) == 1 or self.parts[rank]]
        self.automaton = ahocorasick.Automaton()
        for token in made:
            self.automaton.add_word(token.decode("latin-1"), ranks[token])
        self.automaton.make_automaton()
        made_set = set(made)
        self.shorter = {}
        for token in made:
            cut = next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in made_set), None)
            self.shorter[ranks[token]] = None if cut is None else ranks[cut]
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self._fits: dict[tuple[int, int], bool] = {}
        self._piece_ids: dict[str, bytes] = {}
        self._chunk_ids = _Remembered(lambda chunk: self._encode_chunk(" " + chunk))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, each as four little-endian bytes."""
        chunks = space_chunks(text)
        if chunks is None:
            return self._encode_chunk(text)
        return self._encode_chunk(chunks[0]) + b"".join(map(self._chunk_ids.get_ids, chunks[1:]))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def _encode_chunk(self, chunk: str) -> bytes:
        known, found = self._piece_ids, []
        for piece in self.pieces.findall(chunk):
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
                if len(piece) <= _LONGEST:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[piece] = ids
            found.append(ids)
        return b"".join(found)

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of one match of the pattern."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        size = len(piece)
        longest = [-1] * size
        length, automaton = self.length, self.automaton
        for end, token in automaton.iter(piece.decode("latin-1")):
            start = end + 1 - length[token]
            best = longest[start]
            if best < 0 or length[best] < length[token]:
                longest[start] = token
        alive = bytearray(b"\1" * (size + 1))
        tokens: list[int] = []
        place, token = 0, longest[0]
        while True:
            last = tokens[-1] if tokens else None
            while True:
                end = place + length[token]
                if alive[end] and (last is None or self._fit(last, token)):
                    tokens.append(token)
                    place = end
                    if place == size:
                        return tokens
                    token = longest[place]
                    break
                cut = self.shorter[token]
                if cut is not None:
                    token = cut
                    continue
                alive[place] = 0
                token = tokens.pop()
                place -= length[token]
                break

    def _fit(self, left: int, right: int) -> bool:
        verdict = self._fits.get((left, right))
        if verdict is None:
            if len(self._fits) >= _REMEMBERED:
                self._fits.clear()
            verdict = self._fits[left, right] = self._stays_apart(left, right)
        return verdict

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves the boundary between them.

        Undoes merges at the boundary from the latest back: a pair that would have merged across
        it before the merge undone last shows that the two tokens never both come about.
        """
        bound = len(self.ranks) + len(self.bytes_of) + 1
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < bound:
                return False
            undo_left, undo_right = self.parts[left], self.parts[right]
            if undo_left is None and undo_right is None:
                return True
            if undo_right is None or undo_left is not None and left > right:
                bound, left = left, undo_left[1]
            else:
                bound, right = right + 1, undo_right[0]

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes and tokens that merging never makes."""
        parts, own = [token[i : i + 1] for i in range(len(token))], self.ranks[token]
        while len(parts) > 2:
            rank, at = min(
                ((self.ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))),
            )
            if rank >= own:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None


class _Remembered(dict):
    """Results of a function by argument; forgets all when full."""

    def __init__(self, function, most: int = _REMEMBERED):
        super().__init__()
        self.function, self.most = function, most
        self.get_ids = self.__getitem__

    def __missing__(self, key: str) -> bytes:
        value = self.function(key)
        if len(key) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


_ENCODERS: dict[tuple[str, str], RankEncoder] = {}


def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """The encoder of a rank file; built once in each Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = RankEncoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encodes every document, decodes the ids again, and returns the ids and digests of both.

    doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit integers), ids_sha256 and
    decoded_sha256 (of the decoded bytes), both in lowercase hex. ``ranks_path`` must be readable at
    the same place on every executor. A null text is encoded as an empty one and gives no ids. Each
    row is encoded on its own, so null, repeated or equal doc_ids and further columns change nothing,
    and no row is shuffled.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple[int, bytes, str, str]] = []
                for text in part.column("text").to_pylist():
                    ids = encoder.encode(text or "")
                    decoded = encoder.decode(ids)
                    rows.append((len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                kinds = (pa.int64(), pa.binary(), pa.string(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
    )
