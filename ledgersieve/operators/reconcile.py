"""Comparing an input with what was written: what is left to do, and whether all is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def remaining_rows(rows: DataFrame, written: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows not yet written.

    With a unique key this is an anti join. Without one, whole rows are compared
    as a multiset: of three equal rows with one written, two remain.
    """
    if key:
        return rows.join(written.select(*key), key, "left_anti")
    return rows.exceptAll(written.select(*rows.columns))


def reconcile(rows: DataFrame, valid: DataFrame, invalid: DataFrame, key: str = "referenceId") -> DataFrame:
    """One row: counts of the three frames, keys lost, repeated, and in both outputs.

    A single aggregate over the tagged union: rows of a key are combined before
    the only shuffle.
    """
    tagged = [
        frame.select(F.col(key).alias("_key"), *[F.lit(int(name == tag)).alias(name) for name in ("i", "v", "n")])
        for tag, frame in (("i", rows), ("v", valid), ("n", invalid))
    ]
    per_key = tagged[0].union(tagged[1]).union(tagged[2]).groupBy("_key").agg(
        F.sum("i").alias("i"), F.sum("v").alias("v"), F.sum("n").alias("n")
    )
    written = F.col("v") + F.col("n")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_key.agg(
        total("i").alias("input_rows"),
        total("v").alias("valid_rows"),
        total("n").alias("invalid_rows"),
        total(F.greatest(F.col("i") - written, F.lit(0))).alias("lost"),
        total(F.greatest(written - F.col("i"), F.lit(0))).alias("repeated"),
        F.count_if((F.col("v") > 0) & (F.col("n") > 0)).alias("in_both"),
    )
