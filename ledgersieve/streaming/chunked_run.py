"""Validation in chunks, with commit, stop and resume.

A directory of transaction files is read as a stream; a chunk is at most
``max_files`` files. Each chunk is checked and written to directories named by its
number, then committed to the checkpoint. A chunk that was cut off is repeated
under the same number and replaces what it had written, so every line ends up in
the outputs exactly once.

One file is never split over chunks; ``block_run`` works in chunks of lines within files.
"""

from __future__ import annotations

import threading
import time
from datetime import datetime, timezone
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import RESTARTABLE_STATUSES
from ..operators.cleanse import cleanse
from ..operators.rules import Rule
from ..plans.batch_run import check_status, find_run, new_run_id
from ..plans.commits import CHUNK, commit
from ..plans.outputs import stage_counted, write_chunk
from ..plans.run_log import append_state, stop_is_requested
from ..plans.validation import Mapper, References, check_lines
from ..sources.transactions import stream_transactions, with_line_id


class _Halt(Exception):
    """Ends the query before a chunk that a stop comes before."""


class ChunkedRun:
    """A run in progress. ``start`` and ``resume`` create it; ``wait`` ends it."""

    def __init__(
        self, spark, output, check, run_id, output_id, input_path, resumed_from, max_files, scan_options,
        max_chunks=None,
    ):
        self.run_id = run_id
        self._spark, self._output, self._output_id, self._check = spark, output, output_id, check
        self._stop, self._halted = threading.Event(), False
        self._chunks_left = max_chunks
        self._state = dict(
            run_id=run_id, output_id=output_id, input_path=input_path, resumed_from=resumed_from,
            start_time=datetime.now(timezone.utc), stoppable=True,
        )
        self._log("STARTED")
        self.query = (
            stream_transactions(spark, input_path, max_files, **scan_options)
            .writeStream.foreachBatch(self._write_chunk)
            .option("checkpointLocation", f"{output}/checkpoints/{output_id}")
            .trigger(availableNow=True)
            .start()
        )

    @classmethod
    def start(
        cls, spark: SparkSession, input_path: str, output: str, references: References,
        *, max_files: int | None = None, max_chunks: int | None = None, rules: list[Rule] | None = None,
        mapper: Mapper = cleanse, **scan_options: str,
    ) -> "ChunkedRun":
        """Starts checking all files that are now in the directory.

        With ``max_chunks`` the run stops by itself after so many chunks.
        """
        run_id = new_run_id()
        check = partial(check_lines, references=references, rules=rules, mapper=mapper)
        return cls(spark, output, check, run_id, run_id, input_path, None, max_files, scan_options, max_chunks)

    @classmethod
    def resume(
        cls, spark: SparkSession, run_id: str, output: str, references: References,
        *, max_files: int | None = None, rules: list[Rule] | None = None, mapper: Mapper = cleanse,
        abandoned: bool = False, **scan_options: str,
    ) -> "ChunkedRun":
        """Goes on after the last committed chunk of a stopped or failed run, as a new execution.

        With ``abandoned`` also of a run that is still running in the log since its driver died.
        """
        run = find_run(spark, output, run_id)
        check_status(run, RESTARTABLE_STATUSES, "resumed", abandoned)
        check = partial(check_lines, references=references, rules=rules, mapper=mapper)
        return cls(spark, output, check, new_run_id(), run.output_id, run.input_path, run_id, max_files, scan_options)

    def request_stop(self) -> None:
        """Asks the run to stop once the chunk in progress is written and committed."""
        if not self.query.isActive:
            raise ValueError(f"run {self.run_id} is not running")
        self._stop.set()

    def wait(self) -> str:
        """Waits for the end and returns the status; raises if the run failed."""
        try:
            self.query.awaitTermination()
        except StreamingQueryException:
            if not self._halted:  # a failure is one, also while a stop is pending
                self._log("FAILED", end_time=datetime.now(timezone.utc))
                raise
            self._log("STOPPED", end_time=datetime.now(timezone.utc))
            return "STOPPED"
        self._log("COMPLETED", end_time=datetime.now(timezone.utc))
        return "COMPLETED"

    def _write_chunk(self, lines: DataFrame, chunk: int) -> None:
        if self._stop.is_set() or stop_is_requested(self._spark, self._output, self.run_id):
            # The chunk is not begun, so the one before it is the last committed.
            self._halted = True
            raise _Halt("stop requested")
        start = datetime.now(timezone.utc)
        results = self._check(with_line_id(lines))
        stored, counts = stage_counted(results, self._output, self._output_id, chunk)
        write_chunk(stored, self._output, self._output_id, chunk)
        # Named by output and number, not by execution: a repeated chunk is counted once.
        commit(
            self._spark, self._output, self._output_id, self.run_id, CHUNK, {chunk: counts}, start, datetime.now(timezone.utc)
        )
        if self._chunks_left is not None:
            self._chunks_left -= 1
            if self._chunks_left <= 0:
                self._stop.set()

    def _log(self, status: str, **values) -> None:
        exit_code = None if status == "STARTED" else status
        append_state(
            self._spark, self._output, seq=time.time_ns(), status=status, exit_code=exit_code, **self._state, **values
        )
