"""A validation run over a fixed set of files: scan, check, store, split, log.

Work is committed in units: first the staged results of all lines, then their ranges, some at a time. A run
that was stopped or has failed is resumed with the units that are left.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import DEFAULT_PARTITIONS, RESTARTABLE_STATUSES, STOPPABLE_STATUSES
from ..operators.cleanse import cleanse
from ..operators.ranges import plan_ranges
from ..operators.rules import Rule
from ..sources.lines import count_lines
from ..sources.transactions import resolve_input, scan_transactions, with_line_id
from .commits import RANGE, STAGE, commit, is_committed, pending
from .outputs import MOST_RANGES, read_staged, stage_counted, write_ranges
from .run_log import STOPPING, append_state, read_runs
from .stopping import RunStopped, StopWatch
from .validation import Mapper, References, check_lines

#: Seconds between two looks at the log for a request to stop.
POLL_SECONDS = 5.0


def new_run_id() -> str:
    """Ids sort by start time."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def run_validation(
    spark: SparkSession,
    input_path: str | None,
    output: str,
    references: References,
    *,
    default_input: str | None = None,
    partitions: int = DEFAULT_PARTITIONS,
    rules: list[Rule] | None = None,
    mapper: Mapper = cleanse,
    ranges_per_commit: int = MOST_RANGES,
    max_ranges: int | None = None,
    physical_lines: bool = False,
    poll_seconds: float | None = POLL_SECONDS,
    **scan_options: str,
) -> str:
    """Checks all lines of the input and writes both outputs; returns the run id.

    Every run has its own directories, so runs add up and none overwrites another. Ranges are written and
    committed ``ranges_per_commit`` at a time; with ``max_ranges`` the run stops by itself after so many.
    ``physical_lines`` also logs the lines of the files and how many of them are no data, by a second, narrow
    pass over the input. A request to stop is seen within ``poll_seconds``; with None the run cannot be stopped.
    """
    path = resolve_input(input_path, default_input)
    run_id = new_run_id()
    _execute(
        spark, path, output, references, run_id, run_id, None, partitions, rules, mapper, scan_options,
        ranges_per_commit, max_ranges, physical_lines, poll_seconds,
    )
    return run_id


def resume_run(
    spark: SparkSession,
    output: str,
    run_id: str,
    references: References,
    *,
    partitions: int | None = None,
    rules: list[Rule] | None = None,
    mapper: Mapper = cleanse,
    abandoned: bool = False,
    ranges_per_commit: int = MOST_RANGES,
    max_ranges: int | None = None,
    physical_lines: bool = False,
    poll_seconds: float | None = POLL_SECONDS,
    **scan_options: str,
) -> str:
    """Goes on with what a stopped or failed run has not committed, as a new execution; returns its id.

    It writes into the directories of the first execution and replaces what that one left of the units it did
    not commit, so no line is lost or written twice and committed ranges are not touched. ``partitions`` may
    only differ while no range is committed. With ``abandoned``, a run that is still running in the log
    is resumed too: use it when its driver has died.
    """
    run = find_run(spark, output, run_id)
    check_status(run, RESTARTABLE_STATUSES, "resumed", abandoned)
    ranges = partitions or run.ranges or DEFAULT_PARTITIONS
    if run.ranges and ranges != run.ranges and is_committed(spark, output, run.output_id, RANGE):
        raise ValueError(f"run {run_id} has committed some of its {run.ranges} ranges; it cannot go on with {ranges}")
    new_id = new_run_id()
    _execute(
        spark, run.input_path, output, references, new_id, run.output_id, run_id, ranges, rules, mapper, scan_options,
        ranges_per_commit, max_ranges, physical_lines, poll_seconds,
    )
    return new_id


def find_run(spark: SparkSession, output: str, run_id: str):
    run = read_runs(spark, output).filter(F.col("run_id") == run_id).first()
    if run is None:
        raise LookupError(f"no run {run_id}")
    return run


def check_status(run, allowed: tuple[str, ...], action: str, abandoned: bool = False) -> None:
    """``abandoned`` also allows a run whose driver is known to be gone, which left it running in the log."""
    if abandoned and run.status in (*STOPPABLE_STATUSES, STOPPING):
        return
    if run.status not in allowed:
        raise ValueError(f"run {run.run_id} is {run.status}; only {' or '.join(allowed)} runs can be {action}")


def _execute(
    spark, path, output, references, run_id, output_id, resumed_from, partitions, rules, mapper, scan_options,
    ranges_per_commit, max_ranges, physical_lines, poll_seconds,
):
    state = dict(
        run_id=run_id, output_id=output_id, input_path=path, resumed_from=resumed_from,
        start_time=datetime.now(timezone.utc), ranges=partitions, stoppable=poll_seconds is not None,
    )
    append_state(spark, output, seq=time.time_ns(), status="STARTED", **state)
    watch = StopWatch(spark, output, run_id, poll_seconds)
    try:
        with watch:
            if physical_lines:
                state |= _line_counts(spark, path, scan_options)
            stored = _staged(spark, path, output, references, run_id, output_id, resumed_from, rules, mapper, scan_options)
            watch.check()
            plan = plan_ranges(stored, partitions)
            open_ranges = list(range(plan.count))
            if resumed_from is not None:
                numbers = spark.range(plan.count).select(F.col("id").cast("int").alias("number"))
                open_ranges = pending(spark, output, output_id, RANGE, numbers)
            for some in _portions(open_ranges[:max_ranges], min(ranges_per_commit, MOST_RANGES)):
                watch.check()
                begin = datetime.now(timezone.utc)
                counts = write_ranges(stored, output, output_id, plan, some)
                commit(spark, output, output_id, run_id, RANGE, counts, begin, datetime.now(timezone.utc))
            if max_ranges is not None and len(open_ranges) > max_ranges:
                raise RunStopped(f"{max_ranges} ranges are written")
    except Exception as error:
        stopped = watch.requested or isinstance(error, RunStopped)
        _end(spark, output, "STOPPED" if stopped else "FAILED", state)
        if not stopped:
            raise
    else:
        _end(spark, output, "COMPLETED", state)


def _staged(spark, path, output, references, run_id, output_id, resumed_from, rules, mapper, scan_options) -> DataFrame:
    """The result rows of all lines, checked unless an earlier execution has committed them."""
    if resumed_from is not None and is_committed(spark, output, output_id, STAGE):
        return read_staged(spark, output, output_id)
    begin = datetime.now(timezone.utc)
    lines = with_line_id(scan_transactions(spark, path, **scan_options))
    stored, counts = stage_counted(check_lines(lines, references, rules, mapper), output, output_id)
    commit(spark, output, output_id, run_id, STAGE, {0: counts}, begin, datetime.now(timezone.utc))
    return stored


def _line_counts(spark: SparkSession, path: str, scan_options: dict[str, str]) -> dict[str, int]:
    found = count_lines(spark, path, **scan_options).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("line_count"), F.coalesce(F.sum("left_out"), F.lit(0)).alias("left_out")
    ).first()
    return found.asDict()


def _portions(numbers: list[int], size: int) -> Iterator[list[int]]:
    for begin in range(0, len(numbers), size):
        yield numbers[begin : begin + size]


def _end(spark: SparkSession, output: str, status: str, state: dict) -> None:
    append_state(
        spark, output, seq=time.time_ns(), status=status, exit_code=status, end_time=datetime.now(timezone.utc), **state
    )
