"""Lines of transaction files as they lie in the files: how many there are, and in which blocks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# What the text reader must do like the CSV reader.
_TEXT_OPTIONS = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter", "lineSep", "encoding")
# The CSV reader leaves out lines without a character beyond these.
_BLANK = r"^[\x00-\x20]*$"


def count_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Per file: lines (all but the header), and how many of them are left_out since they are blank.

    A file's first line that is not blank is its header; a file without one has no lines of data, and one of
    its blank lines counts as the header. Lines with white space or control characters only are blank.
    """
    text_options = {k: v for k, v in options.items() if k in _TEXT_OPTIONS}
    lines = spark.read.options(**text_options).text(path).select(
        F.col("_metadata.file_path").alias("line_file"), F.col("value").rlike(_BLANK).alias("blank")
    )
    counted = lines.groupBy("line_file").agg(F.count("*").alias("physical"), F.count_if("blank").alias("blanks"))
    # Without a header that is not blank, a blank line takes its place.
    left_out = F.least(F.col("blanks"), F.col("physical") - 1).alias("left_out")
    return counted.select("line_file", (F.col("physical") - 1).alias("lines"), left_out)


def file_blocks(scanned: DataFrame, chunk_bytes: int) -> DataFrame:
    """The blocks that files are read in (see ``schemas.BLOCKS``), dealt to chunks of about ``chunk_bytes``.

    One narrow pass: the reader counts lines and parses no field. The window sees one row per block. To be
    evaluated within ``block_size``, as is all else that relies on these blocks.
    """
    placed = scanned.select(
        F.col("_metadata.file_path").alias("line_file"),
        F.col("_metadata.file_block_start").alias("line_block"),
        F.col("_metadata.file_block_length").alias("length"),
    )
    sizes = placed.groupBy("line_file", "line_block").agg(F.max("length").alias("length"), F.count("*").alias("lines"))
    earlier = Window.orderBy("line_file", "line_block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda column: F.coalesce(F.sum(column).over(earlier), F.lit(0).cast("long"))
    return sizes.select(
        "line_file", "line_block", "length", "lines", before("lines").alias("first_line"), before("length").alias("_before")
    ).select("*", F.expr(f"CAST(_before div {chunk_bytes} AS INT)").alias("chunk")).drop("_before")


@contextmanager
def block_size(spark: SparkSession, size: int) -> Iterator[None]:
    """Files are read in blocks that begin at multiples of ``size``, whatever their number and the cluster."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
