"""Writing results and reading them back.

Layout under the output folder, all of it in directories a rerun overwrites:

    results/run_id=R/chunk=N/outcome=O/   parquet, every line with its outcome
    valid/run_id=R/partition=N/           CSV, eleven columns
    invalid/run_id=R/partition=N/         CSV, nine columns
    commits/                              what of it is wholly written

The checks run once, for the results table. The two CSV outputs are plain
projections of it, so nothing is computed twice or held in executor storage.
Lines are counted while they are written. Readers take committed parts only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..fixed_values import INVALID_OUTPUT_FIELDS, TRANSACTION_FIELDS
from ..operators.ranges import RangePlan
from ..schemas import INVALID_OUTPUT, RESULTS, VALID_OUTPUT
from ..session import delete_path, path_exists
from ..sources.transactions import WRITE_OPTIONS
from .commits import CHUNK, RANGE, STAGE
from .run_log import visible_units

_FIELDS = {"valid": TRANSACTION_FIELDS, "invalid": INVALID_OUTPUT_FIELDS}
_SCHEMAS = {"valid": VALID_OUTPUT, "invalid": INVALID_OUTPUT}
#: Ranges that are written by one job and counted by it.
MOST_RANGES = 64


def stage_results(results: DataFrame, output: str, run_id: str, chunk: int = 0) -> DataFrame:
    """Writes the result rows of a run or chunk and returns them as stored."""
    results.write.mode("overwrite").partitionBy("outcome").parquet(_results_path(output, run_id, chunk))
    return read_staged(results.sparkSession, output, run_id, chunk)


def stage_counted(results: DataFrame, output: str, run_id: str, chunk: int = 0) -> tuple[DataFrame, dict[str, int]]:
    """The same, with the numbers of lines by outcome, taken by the write itself."""
    observed = Observation()
    counts = [F.count_if(F.col("outcome") == outcome).alias(outcome) for outcome in ("valid", "invalid", "quarantined")]
    stored = stage_results(results.observe(observed, F.count(F.lit(1)).alias("read"), *counts), output, run_id, chunk)
    found = observed.get
    return stored, {
        "read_count": found["read"], "valid_count": found["valid"], "invalid_count": found["invalid"], "skip_count": found["quarantined"],
    }


def read_staged(spark: SparkSession, output: str, run_id: str, chunk: int = 0) -> DataFrame:
    """The result rows of one run or chunk, committed or not."""
    return spark.read.schema(RESULTS).parquet(_results_path(output, run_id, chunk))


def read_results(spark: SparkSession, output: str) -> DataFrame:
    """All result rows of completed runs and committed chunks, with run_id and chunk."""
    keys = [T.StructField("run_id", T.StringType()), T.StructField("chunk", T.IntegerType())]
    schema = T.StructType(RESULTS.fields + keys)
    if not path_exists(spark, f"{output}/results"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{output}/results")
    return _visible(rows, output, "chunk", STAGE, CHUNK)


def write_ranges(stored: DataFrame, output: str, run_id: str, plan: RangePlan, numbers: list[int]) -> dict[int, dict[str, int]]:
    """Writes both CSV outputs of some ranges and returns their counts, taken by the writes.

    What an earlier attempt left of these ranges goes first. Lines that are neither valid nor invalid are quarantined.
    """
    if len(numbers) > MOST_RANGES:
        raise ValueError(f"at most {MOST_RANGES} ranges are written at once")
    counts = {number: {"read_count": plan.lines_of(number)} for number in numbers}
    labelled = plan.label(stored.filter(plan.spans(numbers))).filter(F.col("partition").isin(numbers))
    for outcome in _FIELDS:
        path = f"{output}/{outcome}/run_id={run_id}"
        for number in numbers:
            delete_path(stored.sparkSession, f"{path}/partition={number}")
        observed = Observation()
        of_range = [F.count_if(F.col("partition") == number).alias(f"n{number}") for number in numbers]
        rows = select_output(labelled, outcome, "partition").observe(observed, *of_range)
        rows.write.mode("append").partitionBy("partition").options(**WRITE_OPTIONS).csv(path)
        found = observed.get
        for number in numbers:
            counts[number][f"{outcome}_count"] = found[f"n{number}"]
    for own in counts.values():
        own["skip_count"] = own["read_count"] - own["valid_count"] - own["invalid_count"]
    return counts


def write_chunk(stored: DataFrame, output: str, run_id: str, chunk: int) -> None:
    """Writes both CSV outputs of one chunk; its partition is the chunk's number."""
    for outcome in _FIELDS:
        path = f"{output}/{outcome}/run_id={run_id}/partition={chunk}"
        select_output(stored, outcome).write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def select_output(results: DataFrame, outcome: str, *extra: str) -> DataFrame:
    """The rows of one outcome with the columns of its file."""
    return results.filter(F.col("outcome") == outcome).select(*_FIELDS[outcome], *extra)


def read_output(spark: SparkSession, output: str, outcome: str) -> DataFrame:
    """One output of all completed runs and committed chunks as one frame, with run_id and partition."""
    path = f"{output}/{outcome}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _SCHEMAS[outcome])
    options = {k: v for k, v in WRITE_OPTIONS.items() if k in ("header", "quote", "escape")}
    rows = spark.read.schema(_SCHEMAS[outcome]).options(**options).csv(path)
    return _visible(rows, output, "partition", RANGE, CHUNK)


def read_both_outputs(spark: SparkSession, output: str) -> DataFrame:
    """Union of both outputs; columns the invalid file leaves out are null."""
    frames = [read_output(spark, output, o).withColumn("outcome", F.lit(o)) for o in _FIELDS]
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


def part_files(spark: SparkSession, output: str) -> DataFrame:
    """The files with lines of both outputs as they lie there, committed or not: outcome, run_id, partition, path."""
    frames = [
        spark.read.schema(_SCHEMAS[outcome]).option("header", "true").csv(f"{output}/{outcome}")
        .select(F.lit(outcome).alias("outcome"), "run_id", "partition", F.col("_metadata.file_path").alias("path")).distinct()
        for outcome in _FIELDS
        if path_exists(spark, f"{output}/{outcome}")
    ]
    schema = "outcome string, run_id string, partition int, path string"
    return reduce(DataFrame.unionAll, frames, spark.createDataFrame([], schema))


def _visible(rows: DataFrame, output: str, part: str, *units: str) -> DataFrame:
    """Rows of parts that readers may see; parts are folders, so those of others are not read."""
    seen = visible_units(rows.sparkSession, output, *units).select(F.col("output_id").alias("run_id"), F.col("number").alias(part))
    return rows.join(seen, ["run_id", part], "left_semi").select(*rows.columns)


def _results_path(output: str, run_id: str, chunk: int) -> str:
    return f"{output}/results/run_id={run_id}/chunk={chunk}"
