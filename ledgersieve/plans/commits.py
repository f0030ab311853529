"""Committed units of runs: what is wholly written, and what of it readers may see.

A unit is the staged results of a run, a range of lines or a chunk of lines. Its row is added after all
its files are written, so files without a row are those of an attempt that was cut off. A unit that was
written again has several rows; the last one counts.

Chunks are read as soon as they are committed: a chunked run never takes one back. The ranges of a
batch run appear together, once an execution of the run has completed.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..session import path_exists

STAGE, RANGE, CHUNK, PLAN = "stage", "range", "chunk", "plan"
_NAMES = [part.split()[0] for part in schemas.COMMITS.split(", ")]


def commit(
    spark: SparkSession, output: str, output_id: str, run_id: str, unit: str, counts: dict[int, dict[str, int]],
    start: datetime, end: datetime,
) -> None:
    """Adds a row for each number in ``counts`` (read, valid, invalid and skipped lines by name)."""
    common = dict(output_id=output_id, unit=unit, run_id=run_id, start_time=start, end_time=end, seq=time.time_ns())
    rows = [tuple((common | {"number": number} | own).get(name) for name in _NAMES) for number, own in counts.items()]
    if rows:
        spark.createDataFrame(rows, schemas.COMMITS).coalesce(1).write.mode("append").parquet(f"{output}/commits")


def read_commits(spark: SparkSession, output: str) -> DataFrame:
    """The last row of every unit."""
    if not path_exists(spark, f"{output}/commits"):
        return spark.createDataFrame([], schemas.COMMITS)
    keys = ["output_id", "unit", "number"]
    rows = spark.read.schema(schemas.COMMITS).parquet(f"{output}/commits")
    return rows.groupBy(*keys).agg(*[F.max_by(c, "seq").alias(c) for c in rows.columns if c not in keys])


def pending(spark: SparkSession, output: str, output_id: str, unit: str, numbers: DataFrame) -> list[int]:
    """Of the units (a column ``number``) of a run those that are not committed, in order."""
    done = read_commits(spark, output).filter((F.col("output_id") == output_id) & (F.col("unit") == unit))
    return [row.number for row in numbers.join(done.select("number"), "number", "left_anti").orderBy("number").collect()]


def is_committed(spark: SparkSession, output: str, output_id: str, unit: str) -> bool:
    """Whether a run has committed any unit of a kind."""
    found = read_commits(spark, output).filter((F.col("output_id") == output_id) & (F.col("unit") == unit))
    return not found.isEmpty()
