"""Ranges of lines, reconciliation and reports."""

from math import ceil

import pytest

from ledgersieve.operators.cleanse import cleanse
from ledgersieve.operators.ranges import range_split
from ledgersieve.operators.reconcile import reconcile, remaining_rows
from ledgersieve.plans import reports, run_log
from ledgersieve.plans.validation import validate_transactions

from .helpers import GOLDEN, raw_frame


@pytest.mark.parametrize("total,ranges", [(10, 4), (13, 2), (5, 10), (1000, 7), (0, 3), (9, 3)])
def test_range_split_is_by_rows_not_by_shares(spark, total, ranges):
    df = spark.range(0, total, 1, 4).selectExpr("id * 7919 % 10007 AS key")
    rows = sorted((r.key, r.partition) for r in range_split(df, ["key"], ranges).collect())
    size = max(1, ceil(total / ranges))
    assert [p for _, p in rows] == [i // size for i in range(total)]


def test_range_split_with_a_hot_key(spark):
    """Half of the rows have one key; they are spread over sort tasks and split by count all the same."""
    df = spark.range(0, 20_000, 1, 8).selectExpr("id", "IF(id % 2 = 0, 500, id % 1000) AS key")
    rows = range_split(df, ["key"], 10)
    sizes = {r.partition: r["count"] for r in rows.groupBy("partition").count().collect()}
    assert sizes == {i: 2000 for i in range(10)}
    spans = rows.groupBy("partition").agg({"key": "min"}).orderBy("partition").collect()
    assert [r[1] for r in spans] == sorted(r[1] for r in spans)


def test_reconcile(spark):
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "referenceId string")
    good = reconcile(frame("abcc"), frame("ac"), frame("bc")).first()
    assert (good.input_rows, good.lost, good.repeated, good.in_both) == (4, 0, 0, 1)
    bad = reconcile(frame("abc"), frame("aa"), frame("b")).first()
    assert (bad.lost, bad.repeated, bad.in_both) == (1, 1, 0)
    none = reconcile(frame(""), frame(""), frame("")).first()
    assert tuple(none) == (0, 0, 0, 0, 0, 0)


def test_remaining_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    written = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sorted(remaining_rows(rows, written).collect()) == [("a", 1), ("c", 3)]
    assert remaining_rows(rows, written, ["k"]).collect() == [("c", 3)]


@pytest.fixture(scope="module")
def checked(spark, references):
    names = ("referenceId", "sourceAccount", "sourceBankCode", "beneficiaryAccount", "beneficiaryBankCode", "amount", "transactionType")
    rows = [dict(zip(names, r)) for r in GOLDEN]
    return validate_transactions(cleanse(raw_frame(spark, rows)), references)


def test_reports(spark, checked):
    assert tuple(reports.validity_totals(checked).first()) == (13, 5, 8)
    assert reports.input_count(checked).first()[0] == 13
    invalid = checked.filter("NOT valid")
    assert dict(reports.errors_by_type(invalid).collect()) == {
        "inactive": 2, "not_found": 4, "bank_code": 2, "below_minimum": 1, "blocked": 1,
    }
    assert reports.rows_with_error(invalid, "BLOCKED").first().referenceId == "TRX-T008"
    assert [r.referenceId for r in reports.preview(invalid).collect()] == ["TRX-T006", "TRX-T007", "TRX-T008", "TRX-T009"]


def test_histogram_is_most_frequent_first(spark, checked):
    twice = checked.filter("NOT valid").union(checked.filter("referenceId = 'TRX-T011'"))
    rows = reports.error_histogram(twice).collect()
    assert tuple(rows[0]) == ("amount 5000 is below the minimum for TRANSFER", 2)
    assert [r.validationErrors for r in rows[1:]] == sorted(r.validationErrors for r in rows[1:])


def test_run_log_states(spark):
    runs = spark.createDataFrame(
        [(1, "STARTED"), (2, "STOPPED"), (3, "FAILED"), (4, "COMPLETED"), (5, "STARTING")], "run_id int, status string"
    )
    assert {r.run_id for r in run_log.stoppable_runs(runs).collect()} == {1, 5}
    assert {r.run_id for r in run_log.restartable_runs(runs).collect()} == {2, 3}
    assert [r.run_id for r in run_log.runs_latest(runs).collect()] == [5, 4, 3, 2, 1]


def test_partitions_are_ordered_by_name_as_text(spark):
    steps = spark.createDataFrame([(1, f"partition-{i}") for i in range(11)], "run_id int, partition_name string")
    assert [r.partition_name for r in run_log.run_partitions(steps, 1).collect()][:3] == [
        "partition-0", "partition-1", "partition-10",
    ]
