"""Summaries of checked transactions and of written outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import ERROR_TEXTS


def validity_totals(checked: DataFrame) -> DataFrame:
    """total, valid_rows and invalid_rows, in one pass."""
    return checked.agg(
        F.count("*").alias("total"),
        F.count_if("valid").alias("valid_rows"),
        F.count_if(~F.col("valid")).alias("invalid_rows"),
    )


def input_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("input_rows"))


def errors_by_type(invalid: DataFrame) -> DataFrame:
    """Rows whose errors contain each of the known texts (error_type, hits), in one pass."""
    errors = F.col("validationErrors")
    counts = invalid.agg(*[F.count_if(errors.contains(text)).alias(name) for name, text in ERROR_TEXTS])
    lines = F.array(
        *[F.struct(F.lit(name).alias("error_type"), F.col(name).alias("hits")) for name, _ in ERROR_TEXTS]
    )
    return counts.select(F.inline(lines))


def rows_with_error(invalid: DataFrame, text: str) -> DataFrame:
    return invalid.filter(F.col("validationErrors").contains(text))


def error_histogram(invalid: DataFrame) -> DataFrame:
    """How often each whole error text occurs, most frequent first."""
    return (
        invalid.groupBy("validationErrors")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "validationErrors")
    )


def output_counts(outputs: DataFrame) -> DataFrame:
    """Rows per outcome and partition, with a line per outcome and a grand total (nulls).

    The rows are counted per part first; the totals are rolled up from the counts.
    """
    parts = outputs.groupBy("outcome", "partition").agg(F.count("*").alias("n"))
    return parts.rollup("outcome", "partition").agg(F.sum("n").alias("n"))


def preview(outputs: DataFrame, rows: int = 4) -> DataFrame:
    """The first rows by reference id (a top-k, not a full sort)."""
    return outputs.orderBy("referenceId").limit(rows)
