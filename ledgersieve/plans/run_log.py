"""The run log: one row per run and state change; what is known of its partitions comes from the commits."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..fixed_values import JOB_NAME, RESTARTABLE_STATUSES, STOPPABLE_STATUSES
from ..functions.text import elapsed_text, local_time_text
from ..session import path_exists
from .commits import CHUNK, RANGE, read_commits

STOPPING = "STOPPING"


def append_state(spark: SparkSession, output: str, **values) -> None:
    """Adds a state of a run; the one with the highest ``seq`` is its current state."""
    names = [part.split()[0] for part in schemas.RUNS.split(", ")]
    row = tuple(values.get(name) for name in names)
    spark.createDataFrame([row], schemas.RUNS).coalesce(1).write.mode("append").parquet(f"{output}/runs")


def request_stop(spark: SparkSession, output: str, run_id: str) -> None:
    """Asks a run to stop; any session that sees the log can ask.

    A chunked run ends after the chunk in progress. A batch run gives up the job in progress; what it has
    committed stays, and a run that has committed everything in the meantime completes.
    """
    run = read_runs(spark, output).filter(F.col("run_id") == run_id).first()
    if run is None:
        raise LookupError(f"no run {run_id}")
    if run.status not in STOPPABLE_STATUSES:
        raise ValueError(f"run {run_id} is {run.status}; only {' or '.join(STOPPABLE_STATUSES)} runs can be stopped")
    if run.stoppable is False:
        raise ValueError(f"run {run_id} was started without looking at the log, so it cannot be stopped")
    state = run.asDict() | {"seq": time.time_ns(), "status": STOPPING}
    append_state(spark, output, **state)


def stop_is_requested(spark: SparkSession, output: str, run_id: str) -> bool:
    states = spark.read.schema(schemas.RUNS).parquet(f"{output}/runs")
    return not states.filter((F.col("run_id") == run_id) & (F.col("status") == STOPPING)).isEmpty()


def read_runs(spark: SparkSession, output: str) -> DataFrame:
    """The current state of every run."""
    states = spark.read.schema(schemas.RUNS).parquet(f"{output}/runs")
    others = [c for c in states.columns if c != "run_id"]
    return states.groupBy("run_id").agg(*[F.max_by(c, "seq").alias(c) for c in others])


def visible_units(spark: SparkSession, output: str, *units: str) -> DataFrame:
    """output_id and number of the units that readers may see."""
    commits = read_commits(spark, output).filter(F.col("unit").isin(*units))
    if not path_exists(spark, f"{output}/runs"):
        return commits.select("output_id", "number").limit(0)
    completed = read_runs(spark, output).filter("status = 'COMPLETED'").select("output_id").distinct()
    finished = commits.join(completed.withColumn("completed", F.lit(True)), "output_id", "left")
    return finished.filter(f"completed OR unit = '{CHUNK}'").select("output_id", "number")


def read_steps(spark: SparkSession, output: str) -> DataFrame:
    """Ranges and chunks as steps of the executions that committed them."""
    return read_commits(spark, output).filter(F.col("unit").isin(RANGE, CHUNK)).select(
        "run_id",
        F.concat(F.lit("partition-"), F.col("number").cast("string")).alias("partition_name"),
        F.lit("COMPLETED").alias("status"),
        "read_count",
        (F.col("valid_count") + F.col("invalid_count")).alias("write_count"),
        "skip_count",
        F.lit(0).cast("bigint").alias("filter_count"),
        "start_time",
        "end_time",
        "unit",
    )


def run_progress(steps: DataFrame) -> DataFrame:
    """Per run: partitions by state and the sums of their counts."""
    with_status = lambda status: F.count_if(F.col("status") == status)
    return steps.groupBy("run_id").agg(
        F.count("*").alias("total_partitions"),
        with_status("COMPLETED").alias("completed"),
        with_status("STARTED").alias("running"),
        with_status("FAILED").alias("failed"),
        F.sum("read_count").alias("total_read"),
        F.sum("write_count").alias("total_written"),
        F.sum("skip_count").alias("total_skipped"),
        F.sum("filter_count").alias("total_filtered"),
    )


def run_partitions(steps: DataFrame, run_id) -> DataFrame:
    """The partitions of one run, ordered by name."""
    return steps.filter(F.col("run_id") == run_id).orderBy("partition_name")


def runs_latest(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("run_id"))


def stoppable_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status").isin(*STOPPABLE_STATUSES))


def restartable_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status").isin(*RESTARTABLE_STATUSES))


def with_elapsed(runs: DataFrame, now: Column | None = None) -> DataFrame:
    return runs.withColumn("elapsed", elapsed_text(F.col("start_time"), F.col("end_time"), now))


def run_status(runs: DataFrame, steps: DataFrame, run_id) -> DataFrame:
    """One row for a run: its state, times, progress (struct) and partitions (array by name).

    Only ranges are listed, since a run has as many as its caller sets. Chunks are counted in ``progress``;
    ``run_partitions`` gives their details as rows.
    """
    mine = steps.filter(F.col("run_id") == run_id)
    entry = F.struct(
        "partition_name", "status", "read_count", "write_count", "skip_count", "filter_count",
        local_time_text(F.col("start_time")).alias("start_time"),
        local_time_text(F.col("end_time")).alias("end_time"),
    )
    listed = mine.filter("unit = 'range'") if "unit" in mine.columns else mine
    details = listed.groupBy("run_id").agg(F.array_sort(F.collect_list(entry)).alias("partitions"))
    counts = run_progress(mine)
    progress = counts.select("run_id", F.struct(*[c for c in counts.columns if c != "run_id"]).alias("progress"))
    run = with_elapsed(runs.filter(F.col("run_id") == run_id))
    return run.join(progress, "run_id", "left").join(details, "run_id", "left").select(
        "run_id",
        F.lit(JOB_NAME).alias("job_name"),
        "status",
        "exit_code",
        local_time_text(F.col("start_time")).alias("start_time"),
        local_time_text(F.col("end_time")).alias("end_time"),
        "elapsed",
        "progress",
        "partitions",
    )
