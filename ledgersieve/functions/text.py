"""Text and time functions, as SQL text or columns.

Expressions over many columns are written as SQL text: Spark parses each in one
step, where a tree of column calls costs a round trip per node.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Trimming removes every character up to and including the space.
_BLANKS = "".join(f"\\u{code:04x}" for code in range(0x21))


def clean_text(column: str) -> str:
    """SQL: trimmed text; a missing value (an empty CSV field) becomes the empty string."""
    return f"btrim(coalesce({column}, ''), '{_BLANKS}')"


def has_control_character(*columns: str) -> str:
    """SQL: true if any of the columns holds a character below the space."""
    return f"(concat_ws('', {', '.join(columns)}) RLIKE '[\\\\x00-\\\\x1f]')"


def is_blank(column: str) -> str:
    return f"({clean_text(column)} = '')"


def quoted(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def fill(template: str, *values: str) -> str:
    """SQL: the template with each {} replaced by the next value, in order."""
    parts = template.split("{}")
    pieces = [quoted(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        pieces += [value, quoted(part)]
    return f"concat({', '.join(pieces)})"


def case_key(column: str) -> str:
    """SQL: join key for columns compared without case."""
    return f"upper({column})"


def elapsed_text(start: Column, end: Column, now: Column | None = None) -> Column:
    """Whole seconds between start and end (or now, if still running), as "75s"."""
    until = F.coalesce(end, F.current_timestamp() if now is None else now)
    return F.concat(F.timestamp_diff("SECOND", start, until).cast("string"), F.lit("s"))


def local_time_text(ts: Column) -> Column:
    """ISO local date-time in its shortest form: no seconds if zero, 3 or 6 decimals if any."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(F.regexp_replace(full, r"(:00)?\.000000$", ""), r"(\.\d{3})000$", "$1")
