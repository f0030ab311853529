"""Explicit schemas. Nothing is ever inferred: account numbers keep leading zeros."""

from pyspark.sql import types as T

from .fixed_values import INVALID_OUTPUT_FIELDS, TRANSACTION_FIELDS

AMOUNT_TYPE = "decimal(38,18)"
CORRUPT_COLUMN = "_corrupt"


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_TRANSACTIONS = text_schema(*TRANSACTION_FIELDS, CORRUPT_COLUMN)
# A line may leave out the note; such lines are parsed a second time with this schema.
RAW_WITHOUT_NOTE = text_schema(*TRANSACTION_FIELDS[:-1], CORRUPT_COLUMN)

BANKS = "code string, name string, ord int"
LIMITS = "transactionType string, minAmount string, maxAmount string, currency string, ord int"
ACCOUNTS = "accountNumber string, accountName string, bankCode string, status string"

# Output files carry their run and partition in the directory name.
_OUTPUT_KEYS = [T.StructField("run_id", T.StringType()), T.StructField("partition", T.IntegerType())]
VALID_OUTPUT = T.StructType(text_schema(*TRANSACTION_FIELDS).fields + _OUTPUT_KEYS)
INVALID_OUTPUT = T.StructType(text_schema(*INVALID_OUTPUT_FIELDS).fields + _OUTPUT_KEYS)

# One row per line read; stored as parquet under results/run_id=.../outcome=...
RESULTS = T.StructType(
    [
        T.StructField("line_file", T.StringType()),
        T.StructField("line_block", T.LongType()),
        T.StructField("line_id", T.LongType()),
    ]
    + text_schema(*TRANSACTION_FIELDS, "validationErrors", "amount_reason", CORRUPT_COLUMN).fields
    + [T.StructField("outcome", T.StringType())]
)

# One row per unit of work that is written as a whole: the staged results of a run, a range or a chunk of lines.
COMMITS = (
    "output_id string, unit string, number int, run_id string, read_count bigint, valid_count bigint, "
    "invalid_count bigint, skip_count bigint, start_time timestamp, end_time timestamp, seq bigint"
)
# output_id names the output directories; an execution that resumes another keeps its output_id. ranges is
# the number of line ranges; line_count and left_out count lines of the files, where that is asked for.
RUNS = (
    "run_id string, output_id string, seq bigint, status string, exit_code string, input_path string, "
    "resumed_from string, start_time timestamp, end_time timestamp, ranges int, stoppable boolean, "
    "line_count bigint, left_out bigint"
)
# Where a part of a file begins, and the chunk of a run that its lines belong to.
BLOCKS = "line_file string, line_block bigint, length bigint, lines bigint, first_line bigint, chunk int"
