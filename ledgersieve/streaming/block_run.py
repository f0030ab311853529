"""Validation in chunks of lines, also within a file, with commit, stop and resume.

Files are cut into blocks (byte ranges, as Spark reads them), and runs of blocks are chunks of about equal
size. Before the first chunk the lines are staged once, by chunk, with their file, block and number, since a
reader of files cannot be sent to a part of one: so a chunk reads its own lines only, and a run that is
resumed goes on with the lines it began with, whatever has happened to the files. Each chunk is
checked, written to directories named by its number and committed. A chunk that was cut off is
repeated under the same number and replaces what it had written.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..fixed_values import RESTARTABLE_STATUSES
from ..operators.cleanse import cleanse
from ..operators.ranges import MAP_BLOCKS
from ..operators.rules import Rule
from ..plans.batch_run import check_status, find_run, new_run_id
from ..plans.commits import CHUNK, PLAN, commit, is_committed, pending
from ..plans.outputs import stage_counted, write_chunk
from ..plans.run_log import append_state, stop_is_requested
from ..plans.stopping import RunStopped
from ..plans.validation import Mapper, References, check_lines
from ..sources.lines import block_size, file_blocks
from ..sources.transactions import scan_transactions, with_line_id

#: Bytes of input in a chunk, and at most in a block.
CHUNK_BYTES, BLOCK_BYTES = 4 << 30, 128 << 20

_PLACED = [T.StructField("line_file", T.StringType()), T.StructField("line_block", T.LongType()), T.StructField("line_id", T.LongType())]
_STAGED = T.StructType(schemas.RAW_TRANSACTIONS.fields + _PLACED + [T.StructField("chunk", T.IntegerType())])


def run_in_blocks(
    spark: SparkSession, input_path: str, output: str, references: References, *, chunk_bytes: int = CHUNK_BYTES,
    max_chunks: int | None = None, rules: list[Rule] | None = None, mapper: Mapper = cleanse, **scan_options: str,
) -> str:
    """Checks all lines of the input in chunks of about ``chunk_bytes``; returns the run id.

    With ``max_chunks`` the run stops by itself after so many. A request to stop takes effect before the next chunk.
    """
    run_id = new_run_id()
    _execute(spark, input_path, output, references, run_id, run_id, None, chunk_bytes, max_chunks, rules, mapper, scan_options)
    return run_id


def resume_in_blocks(
    spark: SparkSession, run_id: str, output: str, references: References, *, chunk_bytes: int = CHUNK_BYTES,
    max_chunks: int | None = None, rules: list[Rule] | None = None, mapper: Mapper = cleanse, abandoned: bool = False,
    **scan_options: str,
) -> str:
    """Goes on with the chunks that a stopped or failed run has not committed, as a new execution; returns its id.

    ``chunk_bytes`` and the scan options only count if the run ended before its lines were staged.
    """
    run = find_run(spark, output, run_id)
    check_status(run, RESTARTABLE_STATUSES, "resumed", abandoned)
    new_id = new_run_id()
    _execute(
        spark, run.input_path, output, references, new_id, run.output_id, run_id, chunk_bytes, max_chunks, rules, mapper, scan_options
    )
    return new_id


def read_blocks(spark: SparkSession, output: str, output_id: str) -> DataFrame:
    """The blocks of a run: file, start, length, lines, place of the first line, chunk."""
    return spark.read.schema(schemas.BLOCKS).parquet(f"{output}/blocks/run_id={output_id}")


def stage_lines(
    spark: SparkSession, path: str, output: str, output_id: str, chunk_bytes: int, scan_options: dict[str, str]
) -> int:
    """Writes the blocks of the input and its lines by chunk; returns the number of lines.

    Two passes: a narrow one that counts lines by block, and one that copies them. No line is shuffled.
    """
    with block_size(spark, min(chunk_bytes, BLOCK_BYTES)):
        scanned = scan_transactions(spark, path, **scan_options)
        file_blocks(scanned, chunk_bytes).write.mode("overwrite").parquet(f"{output}/blocks/run_id={output_id}")
        blocks = read_blocks(spark, output, output_id)
        count, lines = blocks.agg(F.count("*"), F.coalesce(F.sum("lines"), F.lit(0))).first()
        chunk_of = blocks.select(F.col("line_file").alias("_file"), F.col("line_block").alias("_block"), "chunk")
        same = (F.col("line_file") == F.col("_file")) & (F.col("line_block") == F.col("_block"))
        placed = with_line_id(scanned).join(F.broadcast(chunk_of) if count <= MAP_BLOCKS else chunk_of, same, "left")
        # A line without a block would be lost later on, so it fails the run.
        known = F.coalesce("chunk", F.raise_error(F.lit("the input has changed while it was read")).cast("int"))
        placed = placed.withColumn("chunk", known).select(*_STAGED.fieldNames())
        placed.write.mode("overwrite").partitionBy("chunk").parquet(f"{output}/staged/run_id={output_id}")
    return lines


def _execute(spark, path, output, references, run_id, output_id, resumed_from, chunk_bytes, max_chunks, rules, mapper, scan_options):
    state = dict(
        run_id=run_id, output_id=output_id, input_path=path, resumed_from=resumed_from,
        start_time=datetime.now(timezone.utc), stoppable=True,
    )
    append_state(spark, output, seq=time.time_ns(), status="STARTED", **state)
    try:
        _run_chunks(spark, path, output, references, run_id, output_id, chunk_bytes, max_chunks, rules, mapper, scan_options)
    except Exception as error:
        status = "STOPPED" if isinstance(error, RunStopped) else "FAILED"
        _end(spark, output, status, state)
        if status == "FAILED":
            raise
    else:
        _end(spark, output, "COMPLETED", state)


def _run_chunks(spark, path, output, references, run_id, output_id, chunk_bytes, max_chunks, rules, mapper, scan_options):
    if not is_committed(spark, output, output_id, PLAN):
        begin = datetime.now(timezone.utc)
        lines = stage_lines(spark, path, output, output_id, chunk_bytes, scan_options)
        commit(spark, output, output_id, run_id, PLAN, {0: {"read_count": lines}}, begin, datetime.now(timezone.utc))
    staged = spark.read.schema(_STAGED).parquet(f"{output}/staged/run_id={output_id}")
    numbers = read_blocks(spark, output, output_id).select(F.col("chunk").alias("number")).distinct()
    for done, chunk in enumerate(pending(spark, output, output_id, CHUNK, numbers)):
        if done == max_chunks or stop_is_requested(spark, output, run_id):
            raise RunStopped(f"run {run_id} ends before chunk {chunk}")
        begin = datetime.now(timezone.utc)
        lines = staged.filter(F.col("chunk") == chunk).drop("chunk")
        stored, counts = stage_counted(check_lines(lines, references, rules, mapper), output, output_id, chunk)
        write_chunk(stored, output, output_id, chunk)
        commit(spark, output, output_id, run_id, CHUNK, {chunk: counts}, begin, datetime.now(timezone.utc))


def _end(spark: SparkSession, output: str, status: str, state: dict) -> None:
    append_state(
        spark, output, seq=time.time_ns(), status=status, exit_code=status, end_time=datetime.now(timezone.utc), **state
    )
