"""Token ids in one succinct file per shard: a wavelet matrix with rank and select.

A shard holds the ids of consecutive documents. Ids are numbered densely within the shard, and each
bit of these numbers is a plane: the top plane in text order, each next plane in the order left by
sorting stably on the plane above. A plane keeps a running count of ones every 512 bits, so ranks
cost a few words of reading. Layout, all little-endian::

    "WVM1", documents u32, ids u64, symbols u32, planes u32
    doc_id i64 per document, doc_id is null u8 per document, ids u32 per document
    id u32 per symbol, count u32 per symbol
    per plane: zeros u64, ones before each block u32, blocks of 64 bytes
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from .texts import slices, stored

_HEAD = struct.Struct("<4sIQII")
_BLOCK = 512


def pack_shard(ids: np.ndarray, lengths: list[int], doc_ids: list[int | None]) -> bytes:
    """The file of a shard: ids (unsigned, of all documents in turn), ids and doc_id of each document."""
    size, top = len(ids), int(ids.max(initial=0)) + 1
    counts = np.bincount(ids, minlength=top)
    symbols = np.flatnonzero(counts).astype("<u4")
    dense = np.zeros(top, dtype=np.uint16 if len(symbols) <= 65536 else np.uint32)
    dense[symbols] = np.arange(len(symbols))
    planes = max(1, int(len(symbols) - 1).bit_length()) if len(symbols) else 0
    parts = [
        _HEAD.pack(b"WVM1", len(lengths), size, len(symbols), planes),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
        np.array(lengths, dtype="<u4").tobytes(),
        symbols.tobytes(),
        counts[symbols].astype("<u4").tobytes(),
    ]
    order, lower = dense[ids], np.empty(size, dtype=dense.dtype)
    packed = np.zeros(-(-size // _BLOCK) * _BLOCK // 8, dtype="u1")
    for plane in reversed(range(planes)):
        ones = (order & order.dtype.type(1 << plane)) != 0
        packed[: -(-size // 8)] = np.packbits(ones, bitorder="little")
        before = np.cumsum(np.bitwise_count(packed.view("<u8")).reshape(-1, 8).sum(axis=1, dtype=np.uint32))
        zeros = size - int(before[-1]) if size else 0
        np.compress(ones, order, out=lower[zeros:])
        np.logical_not(ones, out=ones)
        np.compress(ones, order, out=lower[:zeros])
        order, lower = lower, order
        parts += [struct.pack("<Q", zeros), np.r_[0, before[:-1]].astype("<u4").tobytes(), packed.tobytes()]
    return b"".join(parts)


class Shard:
    """Reads a shard's file without unpacking it."""

    def __init__(self, file: bytes):
        magic, documents, self.size, symbols, planes = _HEAD.unpack_from(file)
        if magic != b"WVM1":
            raise ValueError("no wavelet shard")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(file, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        ids, nulls = take("<i8", documents), take("u1", documents)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls, strict=True)]
        self.lengths = take("<u4", documents)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        self.symbols, self.counts = take("<u4", symbols), take("<u4", symbols)
        blocks = -(-self.size // _BLOCK)
        self.planes = []
        for _ in range(planes):
            zeros = int(take("<u8", 1)[0])
            self.planes.append((zeros, take("<u4", blocks), take("u1", blocks * _BLOCK // 8)))

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        code = 0
        for zeros, before, bits in self.planes:
            one = bits[place >> 3] >> (place & 7) & 1
            ones = self._ones(before, bits, place)
            place = zeros + ones if one else place - ones
            code = code << 1 | int(one)
        return int(self.symbols[code])

    def rank(self, token: int, end: int) -> int:
        """How often an id occurs before a place."""
        span = self._descend(token, 0, min(max(end, 0), self.size))
        return 0 if span is None else span[1] - span[0]

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs between two places."""
        return self.rank(token, self.size if end is None else end) - self.rank(token, start)

    def select(self, token: int, nth: int) -> int:
        """The place of the nth occurrence of an id, from 0."""
        span = self._descend(token, 0, self.size)
        if span is None or not 0 <= nth < span[1] - span[0]:
            raise IndexError(nth)
        place, code = span[0] + nth, self._code(token)
        for plane, (zeros, before, bits) in zip(range(len(self.planes)), reversed(self.planes), strict=True):
            one = code >> plane & 1
            place = self._place_of(before, bits, place - zeros if one else place, one)
        return place

    def occurrences(self, token: int) -> list[int]:
        """All places of an id, ascending."""
        return [self.select(token, n) for n in range(self.count(token))]

    def document(self, number: int) -> np.ndarray:
        """The ids of one document of the shard."""
        return np.array([self.access(i) for i in range(self.starts[number], self.starts[number + 1])], dtype="<u4")

    def all_ids(self) -> np.ndarray:
        """All ids in order: undoes the sorting plane by plane, from the bottom up."""
        codes = np.arange(len(self.symbols), dtype=np.uint32)
        reversed_bits = sum(((codes >> b & 1) << (len(self.planes) - 1 - b) for b in range(len(self.planes))), codes * 0)
        bottom = np.argsort(reversed_bits, kind="stable")
        order = np.repeat(self.symbols[bottom], self.counts[bottom])
        above = np.empty_like(order)
        for zeros, _, bits in reversed(self.planes):
            ones = np.unpackbits(bits, count=self.size, bitorder="little").view(bool)
            above[np.flatnonzero(ones)] = order[zeros:]
            np.logical_not(ones, out=ones)
            above[np.flatnonzero(ones)] = order[:zeros]
            order, above = above, order
        return order

    def _code(self, token: int) -> int | None:
        code = int(np.searchsorted(self.symbols, token))
        return code if code < len(self.symbols) and self.symbols[code] == token else None

    def _descend(self, token: int, start: int, end: int) -> tuple[int, int] | None:
        """Where the occurrences of an id between two places lie below the last plane."""
        if (code := self._code(token)) is None:
            return None
        for plane, (zeros, before, bits) in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            ones = self._ones(before, bits, start), self._ones(before, bits, end)
            start, end = (zeros + ones[0], zeros + ones[1]) if code >> plane & 1 else (start - ones[0], end - ones[1])
        return start, end

    @staticmethod
    def _ones(before: np.ndarray, bits: np.ndarray, place: int) -> int:
        block = place // _BLOCK
        if block == len(before):
            if not block:
                return 0
            block -= 1
        first = block * _BLOCK // 8
        whole = int(np.bitwise_count(bits[first : place >> 3]).sum())
        part = int(bits[place >> 3] & ((1 << (place & 7)) - 1)).bit_count() if place & 7 else 0
        return int(before[block]) + whole + part

    @staticmethod
    def _place_of(before: np.ndarray, bits: np.ndarray, nth: int, one: int) -> int:
        """The place of the nth one (or zero) of a plane, from 0."""
        counts = before if one else np.arange(len(before), dtype=np.int64) * _BLOCK - before
        block = int(np.searchsorted(counts, nth, side="right")) - 1
        inside = np.unpackbits(bits[block * _BLOCK // 8 : (block + 1) * _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(inside == one)[nth - int(counts[block])])


#: Pieces that are matches of the token pattern of their own: Latin letters, ASCII marks but the apostrophe, a line end.
_PIECES = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+|[!-&(-/:-@\[-`{-~]+|\n")
#: A chunk of such pieces only: a word and marks, and more of them on further lines.
_PLAIN_CHUNK = re.compile(r"W+M*(?:\nW+M*)*".replace("W", "[A-Za-zÀ-ÖØ-öø-ɏ]").replace("M", r"[!-&(-/:-@\[-`{-~]")).fullmatch
#: The same, as Arrow takes it apart.
_PLAIN_PARTS = r"^(?P<word>W+)(?P<marks>M*)(?P<lines>(?:\nW+M*)*)$".replace("W", "[A-Za-zÀ-ÖØ-öø-ɏ]").replace("M", r"[!-&(-/:-@\[-`{-~]")
_SPACE_AFTER_OTHERS = re.compile(r"(?<=\S) ")
#: All characters of white space.
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Bytes of text whose chunks are told apart in one step.
_STEP = 4 << 20
#: Bytes that a worker may spend on remembered chunks; longer chunks than this are not remembered.
_ROOM, _LONGEST, _ENTRY = 176 << 20, 64, 200


def _byte_characters() -> list[str]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1 as it is, the others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class _Remembered(dict):
    """Ids by chunk, asked for where they are not known; emptied when they fill their room."""

    def __init__(self, ask, room: int):
        super().__init__()
        self._ask, self._room, self._left = ask, room, room

    def __missing__(self, chunk: str) -> bytes:
        ids = self._ask(chunk)
        if len(chunk) <= _LONGEST:
            self._left -= len(chunk) + len(ids) + _ENTRY
            if self._left < 0:
                self.clear()
                self._left = self._room
            self[chunk] = ids
        return ids


class LibraryEncoder:
    """The tokenizers library, asked once for each chunk of text that recurs.

    With a file whose splitting of texts is the common byte-level one, texts are cut before spaces. Arrow
    tells the different chunks of a batch apart, and the different words of those, so that each is looked
    up once a batch, and lays out their ids in text order. A chunk whose pieces are matches of the file's
    pattern goes to the library's model at once, piece by piece, without that splitting. All other chunks,
    and with any other file whole texts, go through the whole library.
    """

    def __init__(self, path: str, room: int = _ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = _tokenizer(path)
        self._model, self._written = self.tokenizer.model.tokenize, dict(enumerate(_byte_characters()))
        self._words = _Remembered(lambda word: self._piece(" " + word), room * 5 // 8)
        self._pieces = _Remembered(self._piece, room // 8)
        self._lines = _Remembered(self._pieces_of, room // 8)
        self._others = _Remembered(lambda chunk: self._ids([" " + chunk])[0], room // 8)
        self._plain = _splits_at_bytes(path)

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of whole texts, each as four little-endian bytes; a null is an empty text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self._plain or not len(texts):
            return self._whole(texts)
        chunks = _space_chunks(texts)
        bounds, coded = chunks.offsets.to_numpy(), chunks.flatten().dictionary_encode()
        codes, different, first = coded.indices.to_numpy(), coded.dictionary, bounds[:-1]
        later = np.ones(len(codes), dtype=bool)
        later[first] = False
        heads = self._whole(different.take(pa.array(codes[first])))
        # Ids of the first chunk of each text, then of the different chunks after spaces.
        used = np.flatnonzero(np.bincount(codes[later], minlength=len(different)))
        pool = pa.concat_arrays([_binary(heads), self._chunks(different.take(pa.array(used)))])
        place = np.zeros(len(different), dtype=np.int32)
        place[used] = np.arange(len(heads), len(pool))
        places = place[codes]
        places[first] = np.arange(len(heads))
        laid = pool.take(pa.array(places))
        ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[bounds].tolist()
        ids = memoryview(laid.buffers()[2] or b"")
        return [bytes(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _chunks(self, chunks: pa.Array) -> pa.Array:
        """The ids of chunks after a space."""
        parts = pc.extract_regex(chunks, _PLAIN_PARTS)
        known = (("word", self._words), ("marks", self._pieces), ("lines", self._lines))
        ids = [_looked_up(remembered, pc.struct_field(parts, name).dictionary_encode()) for name, remembered in known]
        joined = pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))
        others = joined.is_null()
        return pc.replace_with_mask(joined, others, _binary(map(self._others.__getitem__, _strings(chunks.filter(others)))))

    def _pieces_of(self, lines: str) -> bytes:
        return b"".join([self._pieces[piece] for piece in _PIECES.findall(lines)])

    def _piece(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self._written)
        return array("I", [token.id for token in self._model(written)]).tobytes()

    def _whole(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts by the whole library, some at a time, since its results take much room."""
        batch = pa.record_batch([texts], ["text"])
        return [ids for rows in slices(batch, "text") for ids in self._ids(_strings(rows.column("text")))]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _space_chunks(texts: pa.Array) -> pa.ListArray:
    """Texts cut before every space that follows something that is no white space.

    The pattern never lets a token run from other characters into a space, so such chunks can be encoded
    alone. All but the first chunk begin with a space, which is left out. Texts with white space before
    a space, where the pattern looks across a cut at every space, are cut again.
    """
    chunks = pc.split_pattern(texts, " ")
    bounds, parts = chunks.offsets.to_numpy(), chunks.flatten()
    length, bare = (pc.binary_length(x).to_numpy() for x in (parts, pc.utf8_rtrim(parts, _WHITE)))
    blank = (length == 0) | (bare < length)
    blank[bounds[1:] - 1] = False  # no cut follows
    blank[bounds[:-1]] &= length[bounds[:-1]] > 0  # nothing comes before a cut at the very start
    again = np.unique(np.searchsorted(bounds, np.flatnonzero(blank), side="right") - 1)
    if not len(again):
        return chunks
    cut = pa.array([_SPACE_AFTER_OTHERS.split(text) for text in _strings(texts.take(pa.array(again)))], chunks.type)
    rows = np.arange(len(texts))
    rows[again] = np.arange(len(texts), len(texts) + len(again))
    return pa.concat_arrays([chunks, cut]).take(pa.array(rows))


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


def _binary(values: Iterable[bytes]) -> pa.Array:
    return pa.array(list(values), pa.large_binary())


def _looked_up(known: _Remembered, texts: pa.DictionaryArray) -> pa.Array:
    """What is known for each text, null for null."""
    return _binary(map(known.__getitem__, _strings(texts.dictionary))).take(texts.indices)


@cache
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@cache
def _splits_at_bytes(path: str) -> bool:
    """Whether a tokenizer's file splits texts by the common byte-level pattern and changes them in no other way."""
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    split, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
    common = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    bare = not any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "fuse_unk"))
    special = [token["content"] for token in file.get("added_tokens") or ()]
    free = not any(_PLAIN_CHUNK(content.strip()) or " " in content for content in special)
    return common and bare and free and model.get("type") == "BPE" and file.get("normalizer") is None and file.get("truncation") is None


_ENCODERS: dict[str, LibraryEncoder] = {}


def _library_encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, shard_ids: int = 2_000_000) -> DataFrame:
    """Encodes whole texts and writes them as shard files; returns the written table.

    Each text is encoded by the tokenizers library's file at ``tokenizer_path`` (readable on every
    executor) and gets ``end_id`` at its end. Documents are ranged by doc_id, null first; equal
    doc_ids by a hash of the text, so that copies of one id can lie in several tasks too. A file is
    closed once it has ``shard_ids`` ids, and a document is never cut, so a task holds one file at a time.

    part, seq (order of the files), n_docs, n_ids, file (binary). A null text gives the end id
    alone. Further columns are ignored. No documents: no files.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _library_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        size = 0

        def close() -> pa.RecordBatch:
            file = pack_shard(np.frombuffer(b"".join(held), dtype="<u4"), [len(x) // 4 for x in held], names)
            row = [[part], [seq], [len(held)], [size], [file]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "seq", "n_docs", "n_ids", "file"]
            )

        for batch in batches:
            for rows in slices(batch, "text", _STEP):
                encoded = encoder.encode(rows.column("text"))
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                    held.append(ids + end)
                    names.append(doc_id)
                    size += len(held[-1]) // 4
                    if size >= shard_ids:
                        yield close()
                        held, names, size, seq = [], [], 0, seq + 1
        if held:
            yield close()

    ranged = (
        docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    return stored(ranged.mapInArrow(pack, "part int, seq int, n_docs long, n_ids long, file binary"), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """What the files say of each document: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The window without a partition sees one
    narrow row per file; the files themselves are read once and not shuffled.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, file in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file")), strict=True):
                shard = Shard(file)
                data, starts = memoryview(shard.all_ids().astype("<u4").tobytes()), shard.starts
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                count = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, part, dtype=np.int32)), pa.array(np.full(count, seq, dtype=np.int32)),
                        pa.array(shard.doc_ids, pa.int64()), pa.array(starts[:-1]),
                        pa.array(shard.lengths.astype(np.int64)), pa.array(crcs, pa.int64()),
                    ],
                    ["of_part", "of_seq", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    found = shards.select("part", "seq", "file").mapInArrow(
        unpack, "of_part int, of_seq int, doc_id long, place long, n_tokens long, ids_crc32 long"
    )
    in_order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(in_order), F.lit(0)).alias("offset"))
    same = (F.col("part") == F.col("of_part")) & (F.col("seq") == F.col("of_seq"))
    return found.join(offsets, same).select("doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
