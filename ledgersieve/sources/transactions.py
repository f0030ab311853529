"""Transaction files: eleven text columns, one header line, comma separated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import CSV_HEADER, TRANSACTION_FIELDS
from ..schemas import CORRUPT_COLUMN, RAW_TRANSACTIONS, RAW_WITHOUT_NOTE

# Quotes inside a quoted field are doubled; a backslash is an ordinary character.
PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    "quote": '"',
    "escape": '"',
}
READ_OPTIONS = {**PARSE_OPTIONS, "header": "true"}
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def resolve_input(path: str | None, default: str | None) -> str:
    """The given path, or the default if none or a blank one is given."""
    chosen = path if path and path.strip() else default
    if not chosen:
        raise ValueError("no input path given and no default set")
    return chosen


def scan_transactions(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All lines of a file, directory or glob as text, plus the corrupt-record column.

    An unreadable path raises. Lines with a wrong number of fields stay in the
    result with their text in the corrupt-record column.
    """
    return spark.read.schema(RAW_TRANSACTIONS).options(**READ_OPTIONS).options(**options).csv(path)


def stream_transactions(spark: SparkSession, path: str, max_files: int | None = None, **options: str) -> DataFrame:
    """The same as a file stream; a trigger takes at most ``max_files`` new files."""
    reader = spark.readStream.schema(RAW_TRANSACTIONS).options(**READ_OPTIONS).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_line_source(reader.csv(path))


def with_line_source(scanned: DataFrame) -> DataFrame:
    """Adds line_file and line_block, where the split of the file starts; only a scan knows them."""
    return scanned.select(
        "*",
        F.col("_metadata.file_path").alias("line_file"),
        F.col("_metadata.file_block_start").alias("line_block"),
    )


def with_line_id(scanned: DataFrame) -> DataFrame:
    """Adds line_id, and line_file and line_block unless they are there.

    Within a split ids are gapless and grow with the position of the line, so the three
    together give the order of all lines, however Spark packs splits into tasks. Must be
    applied right to a scan of files, before any filter.
    """
    placed = scanned if "line_file" in scanned.columns else with_line_source(scanned)
    return placed.withColumn("line_id", F.monotonically_increasing_id())


def rescue_short_lines(scanned: DataFrame) -> DataFrame:
    """Accepts lines that only lack the note; other malformed lines stay marked as corrupt."""
    # The parser takes fewer options for a column than for a file, but the same ones here.
    reparsed = F.from_csv(F.col(CORRUPT_COLUMN), _ddl(RAW_WITHOUT_NOTE), PARSE_OPTIONS)
    kept = [c for c in scanned.columns if c not in RAW_TRANSACTIONS.fieldNames()]
    df = scanned.withColumn("_short", F.when(F.col(CORRUPT_COLUMN).isNotNull(), reparsed))
    is_short = F.col(CORRUPT_COLUMN).isNotNull() & F.col(f"_short.{CORRUPT_COLUMN}").isNull()

    def field(name: str) -> Column:
        short = F.lit(None).cast("string") if name == "note" else F.col(f"_short.{name}")
        return F.when(is_short, short).otherwise(F.col(name)).alias(name)

    corrupt = F.when(~is_short, F.col(CORRUPT_COLUMN)).alias(CORRUPT_COLUMN)
    return df.select(*kept, *[field(n) for n in TRANSACTION_FIELDS], corrupt)


def write_transaction_files(transactions: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Writes raw transactions in the input format, each task one file or several of limited size."""
    named = transactions.select(*[F.col(f).alias(h) for f, h in zip(TRANSACTION_FIELDS, CSV_HEADER)])
    named.write.mode("overwrite").options(**WRITE_OPTIONS, maxRecordsPerFile=rows_per_file).csv(path)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
