"""Words, chunks and small columns helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import new_work_dir

#: A word is a run of anything but ASCII white space. ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters handed to one numpy step; bounds the memory of a Python worker.
SLICE_CHARS = 1_000_000

_SPACE_AFTER_SPACE = re.compile(r"\s ")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and returns a frame that reads them: lineage ends here."""
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def space_chunks(text: str) -> list[str] | None:
    """The text cut before every space, if every space follows something that is no white space.

    Token patterns of byte-level BPE never let a token run from other characters into a space, so
    such chunks can be encoded alone. All but the first chunk begin with a space, which is left out.
    None if white space comes before a space: there the pattern looks across the cut.
    """
    return None if _SPACE_AFTER_SPACE.search(text) else text.split(" ")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``most`` bytes of text each; a longer text is a run of its own."""
    offset, begin, size = 0, 0, 0
    for length in _lengths(batch, column):
        if size and size + length > most:
            yield batch.slice(begin, offset - begin)
            begin, size = offset, 0
        offset, size = offset + 1, size + length
    if offset > begin:
        yield batch.slice(begin, offset - begin)


def _lengths(batch: pa.RecordBatch, column: str) -> list[int]:
    return pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
