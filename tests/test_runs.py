"""Batch and chunked runs: outputs, log, stop and resume."""

import pytest

from ledgersieve.fixed_values import INVALID_OUTPUT_FIELDS, TRANSACTION_FIELDS
from ledgersieve.plans import run_log
from ledgersieve.plans.batch_run import resume_run, run_validation
from ledgersieve.plans.outputs import read_both_outputs, read_output, read_results
from ledgersieve.plans.reports import output_counts
from ledgersieve.streaming.chunked_run import ChunkedRun

from .helpers import GOLDEN, golden_line, write_csv

LINES = [golden_line(r) for r in GOLDEN]


def test_batch_run(spark, references, tmp_path):
    source, out = write_csv(tmp_path / "in.csv", [*LINES, "broken,line"]), str(tmp_path / "out")
    run_id = run_validation(spark, source, out, references, partitions=2)

    valid, invalid = read_output(spark, out, "valid"), read_output(spark, out, "invalid")
    assert valid.columns == [*TRANSACTION_FIELDS, "run_id", "partition"]
    assert invalid.columns == [*INVALID_OUTPUT_FIELDS, "run_id", "partition"]
    errors = {r.referenceId: r.validationErrors for r in invalid.collect()}
    assert errors == {r[0]: r[-1] for r in GOLDEN if r[-1]}
    assert {r.referenceId for r in valid.collect()} == {r[0] for r in GOLDEN if not r[-1]}
    # 14 lines in two ranges of 7
    counts = {(r.outcome, r.partition): r.n for r in output_counts(read_both_outputs(spark, out)).collect()}
    assert counts == {
        ("valid", 0): 5, ("invalid", 0): 2, ("invalid", 1): 6, ("valid", None): 5, ("invalid", None): 8, (None, None): 13,
    }
    quarantined = read_results(spark, out).filter("outcome = 'quarantined'").collect()
    assert [r._corrupt for r in quarantined] == ["broken,line"]

    runs, steps = run_log.read_runs(spark, out), run_log.read_steps(spark, out)
    status = run_log.run_status(runs, steps, run_id).first()
    assert (status.status, status.exit_code, status.job_name) == ("COMPLETED", "COMPLETED", "transactionValidationJob")
    assert status.progress.total_read == 14 and status.progress.total_written == 13
    assert status.progress.total_skipped == 1 and status.progress.completed == 2
    assert [(p.partition_name, p.read_count, p.skip_count) for p in status.partitions] == [
        ("partition-0", 7, 0), ("partition-1", 7, 1),
    ]
    assert status.elapsed.endswith("s") and "T" in status.start_time
    with pytest.raises(ValueError, match="only STOPPED or FAILED"):
        resume_run(spark, out, run_id, references)
    with pytest.raises(LookupError):
        resume_run(spark, out, "none", references)


def test_header_of_the_output_files(spark, references, tmp_path):
    out = str(tmp_path / "out")
    run_validation(spark, write_csv(tmp_path / "in.csv", LINES), out, references, partitions=1)
    firsts = {o: next((tmp_path / "out" / o).rglob("*.csv")).read_text().splitlines() for o in ("valid", "invalid")}
    assert firsts["valid"][0] == ",".join(TRANSACTION_FIELDS)
    assert firsts["invalid"][0] == ",".join(INVALID_OUTPUT_FIELDS)
    assert firsts["valid"][1].split(",")[8] == "500000"


def test_own_mapper_and_rules(spark, references, tmp_path):
    from ledgersieve.operators.cleanse import cleanse
    from ledgersieve.operators.rules import Rule

    out = str(tmp_path / "out")
    run_validation(
        spark, write_csv(tmp_path / "in.csv", LINES), out, references, partitions=1,
        rules=[Rule("small", "amount < 60000", "concat('small for ', currency)")],
        mapper=lambda raw: cleanse(raw.withColumn("currency", raw.transactionType)),
    )
    errors = {r.referenceId: r.validationErrors for r in read_output(spark, out, "invalid").collect()}
    assert errors == {
        "TRX-T003": "small for PAYMENT", "TRX-T011": "small for TRANSFER", "TRX-T013": "small for PAYMENT",
    }


def test_runs_add_up(spark, references, tmp_path):
    source, out = write_csv(tmp_path / "in.csv", LINES), str(tmp_path / "out")
    ids = [run_validation(spark, source, out, references, partitions=1) for _ in range(2)]
    assert read_output(spark, out, "valid").count() == 10
    assert [r.run_id for r in run_log.runs_latest(run_log.read_runs(spark, out)).collect()] == sorted(ids, reverse=True)


def test_empty_input(spark, references, tmp_path):
    out = str(tmp_path / "out")
    run_validation(spark, write_csv(tmp_path / "in.csv", []), out, references)
    assert read_both_outputs(spark, out).count() == 0


def test_failed_run_is_resumed_without_repeats(spark, references, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(Exception):
        run_validation(spark, str(tmp_path / "in.csv"), out, references)
    failed = run_log.restartable_runs(run_log.read_runs(spark, out)).first()
    assert failed.status == "FAILED"
    write_csv(tmp_path / "in.csv", LINES)
    new_id = resume_run(spark, out, failed.run_id, references, partitions=2)
    resumed = run_log.read_runs(spark, out).filter(f"run_id = '{new_id}'").first()
    assert (resumed.status, resumed.resumed_from, resumed.output_id) == ("COMPLETED", failed.run_id, failed.run_id)
    assert read_both_outputs(spark, out).count() == 13


def parts(tmp_path, n=4):
    for i in range(n):
        write_csv(tmp_path / "in" / f"{i}.csv", [line.replace("TRX-", f"P{i}-") for line in LINES])
    return str(tmp_path / "in")


def test_chunked_run_stops_after_a_chunk_and_resumes(spark, references, tmp_path):
    source, out = parts(tmp_path), str(tmp_path / "out")
    run = ChunkedRun.start(spark, source, out, references, max_files=1, max_chunks=1)
    assert run.wait() == "STOPPED"
    assert read_both_outputs(spark, out).count() == 13
    again = ChunkedRun.resume(spark, run.run_id, out, references, max_files=1)
    assert again.wait() == "COMPLETED"

    rows = read_both_outputs(spark, out)
    assert rows.count() == rows.select("referenceId").distinct().count() == 52
    expected = {(f"P{i}-{r[0][4:]}", r[-1]) for i in range(4) for r in GOLDEN}
    assert {(r.referenceId, r.validationErrors) for r in rows.collect()} == expected
    with pytest.raises(ValueError, match="not running"):
        again.request_stop()
    status = {r.run_id: r.status for r in run_log.read_runs(spark, out).collect()}
    assert status == {run.run_id: "STOPPED", again.run_id: "COMPLETED"}
    steps = run_log.run_progress(run_log.read_steps(spark, out))
    assert {r.run_id: r.total_read for r in steps.collect()} == {run.run_id: 13, again.run_id: 39}
    with pytest.raises(ValueError):
        ChunkedRun.resume(spark, again.run_id, out, references)


def test_chunk_cut_off_after_writing_is_not_counted_twice(spark, references, tmp_path, monkeypatch):
    """A chunk whose outputs are written but not committed is repeated and replaced."""
    source, out = parts(tmp_path, 3), str(tmp_path / "out")
    write = ChunkedRun._write_chunk

    def fail_after_second(self, lines, chunk):
        write(self, lines, chunk)
        if chunk == 1:
            raise RuntimeError("executor gone")

    monkeypatch.setattr(ChunkedRun, "_write_chunk", fail_after_second)
    run = ChunkedRun.start(spark, source, out, references, max_files=1)
    with pytest.raises(Exception, match="executor gone"):
        run.wait()
    monkeypatch.setattr(ChunkedRun, "_write_chunk", write)
    assert ChunkedRun.resume(spark, run.run_id, out, references, max_files=1).wait() == "COMPLETED"
    rows = read_both_outputs(spark, out)
    assert rows.count() == rows.select("referenceId").distinct().count() == 39
    assert run_log.read_steps(spark, out).selectExpr("sum(read_count)").first()[0] == 39


def test_later_files_are_taken_by_the_next_run_only(spark, references, tmp_path):
    source, out = parts(tmp_path, 1), str(tmp_path / "out")
    run = ChunkedRun.start(spark, source, out, references)
    run.request_stop()
    status = run.wait()
    if status == "STOPPED":
        assert ChunkedRun.resume(spark, run.run_id, out, references).wait() == "COMPLETED"
    assert read_both_outputs(spark, out).count() == 13


def test_elapsed_and_local_time(spark):
    from pyspark.sql import functions as F
    from ledgersieve.functions.text import elapsed_text, local_time_text

    df = spark.sql(
        "SELECT * FROM VALUES (1, '2026-02-20 10:15:30.123', '2026-02-20 10:16:45.678'), (2, '2026-02-20 10:15:00', NULL),"
        "(3, '2026-02-20 10:15:30', NULL), (4, '2026-02-20 10:15:00.000120', NULL) AS t(i, a, b)"
    ).selectExpr("i", "CAST(a AS TIMESTAMP) AS a", "CAST(b AS TIMESTAMP) AS b")
    now = F.lit("2026-02-20 10:15:59.9").cast("timestamp")
    rows = df.select(elapsed_text(F.col("a"), F.col("b"), now).alias("e"), local_time_text(F.col("a")).alias("t")).collect()
    assert [r.e for r in rows] == ["75s", "59s", "29s", "59s"]
    assert [r.t for r in rows] == [
        "2026-02-20T10:15:30.123", "2026-02-20T10:15", "2026-02-20T10:15:30", "2026-02-20T10:15:00.000120",
    ]


def test_stop_by_id_from_another_session(spark, references, tmp_path):
    source, out = parts(tmp_path), str(tmp_path / "out")
    write = ChunkedRun._write_chunk
    other = spark.newSession()

    def stop_after_first(self, lines, chunk):
        write(self, lines, chunk)
        if chunk == 0:
            run_log.request_stop(other, out, self.run_id)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ChunkedRun, "_write_chunk", stop_after_first)
        run = ChunkedRun.start(spark, source, out, references, max_files=1)
        assert run.wait() == "STOPPED"
    assert read_both_outputs(spark, out).count() == 13
    with pytest.raises(ValueError, match="can be stopped"):
        run_log.request_stop(other, out, run.run_id)
    with pytest.raises(LookupError):
        run_log.request_stop(other, out, "none")
    assert ChunkedRun.resume(spark, run.run_id, out, references).wait() == "COMPLETED"
    assert read_both_outputs(spark, out).count() == 52


def test_failure_while_a_stop_is_pending_is_a_failure(spark, references, tmp_path, monkeypatch):
    source, out = parts(tmp_path, 2), str(tmp_path / "out")

    def fail(self, lines, chunk):
        run_log.request_stop(spark, out, self.run_id)
        raise RuntimeError("executor gone")

    monkeypatch.setattr(ChunkedRun, "_write_chunk", fail)
    run = ChunkedRun.start(spark, source, out, references, max_files=1)
    with pytest.raises(Exception, match="executor gone"):
        run.wait()
    assert run_log.read_runs(spark, out).first().status == "FAILED"


def test_abandoned_run_is_resumed_only_when_told(spark, references, tmp_path):
    source, out = parts(tmp_path, 1), str(tmp_path / "out")
    run_log.append_state(spark, out, run_id="r", output_id="r", seq=1, status="STARTED", input_path=source)
    with pytest.raises(ValueError, match="only STOPPED or FAILED"):
        resume_run(spark, out, "r", references)
    resume_run(spark, out, "r", references, abandoned=True)
    assert read_both_outputs(spark, out).count() == 13
