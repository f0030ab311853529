"""Committed ranges and chunks: what is resumed, what is read, how a batch run is stopped."""

import threading
import time

import pytest

from ledgersieve.operators.ranges import label_ranges
from ledgersieve.plans import batch_run, run_log
from ledgersieve.plans.batch_run import find_run, resume_run, run_validation
from ledgersieve.plans.commits import CHUNK, RANGE, STAGE, commit, read_commits
from ledgersieve.plans.outputs import part_files, read_both_outputs, read_results, read_staged
from ledgersieve.sources.lines import block_size, count_lines, file_blocks
from ledgersieve.sources.transactions import scan_transactions
from ledgersieve.streaming import block_run
from ledgersieve.streaming.block_run import read_blocks, resume_in_blocks, run_in_blocks
from ledgersieve.streaming.chunked_run import ChunkedRun

from .helpers import GOLDEN, HEADER, golden_line, write_csv

LINES = [golden_line(r) for r in GOLDEN]


def many_lines(copies):
    return [line.replace("TRX-", f"C{i:03}-") for i in range(copies) for line in LINES]


def expected_ids(copies):
    return sorted(f"C{i:03}-{r[0][4:]}" for i in range(copies) for r in GOLDEN)


def ids(frame):
    return sorted(r.referenceId for r in frame.select("referenceId").collect())


def paths(spark, out):
    return {(r.outcome, r.partition, r.path) for r in part_files(spark, out).collect()}


def numbers(spark, out, unit):
    return sorted(r.number for r in read_commits(spark, out).filter(f"unit = '{unit}'").collect())


def fail_on_call(monkeypatch, module, name, call):
    """The named function raises instead of its ``call``-th call, or after it if ``call`` is negative."""
    function, calls = getattr(module, name), []

    def counted(*args, **kwargs):
        calls.append(1)
        if len(calls) == call:
            raise RuntimeError("executor gone")
        result = function(*args, **kwargs)
        if len(calls) == -call:
            raise RuntimeError("executor gone")
        return result

    monkeypatch.setattr(module, name, counted)


def test_failed_run_goes_on_with_the_ranges_that_are_left(spark, references, tmp_path, monkeypatch):
    source, out = write_csv(tmp_path / "in.csv", many_lines(7)), str(tmp_path / "out")
    with monkeypatch.context() as patch:
        fail_on_call(patch, batch_run, "write_ranges", 3)
        with pytest.raises(RuntimeError, match="executor gone"):
            run_validation(spark, source, out, references, partitions=7, ranges_per_commit=2)
    run = run_log.read_runs(spark, out).first()
    assert (run.status, run.ranges) == ("FAILED", 7)
    assert numbers(spark, out, RANGE) == [0, 1, 2, 3] and numbers(spark, out, STAGE) == [0]
    assert read_both_outputs(spark, out).count() == read_results(spark, out).count() == 0
    before, results = paths(spark, out), set(read_staged(spark, out, run.run_id).inputFiles())
    assert {p for _, p, _ in before} == {0, 1, 2, 3}

    with pytest.raises(ValueError, match="cannot go on with 3"):
        resume_run(spark, out, run.run_id, references, partitions=3)
    (tmp_path / "in.csv").unlink()  # what is staged needs no input
    new = resume_run(spark, out, run.run_id, references)
    assert find_run(spark, out, new).status == "COMPLETED"
    assert ids(read_both_outputs(spark, out)) == expected_ids(7)
    assert before < paths(spark, out) and set(read_staged(spark, out, run.run_id).inputFiles()) == results
    steps = {(r.partition_name, r.run_id == new, r.read_count) for r in run_log.read_steps(spark, out).collect()}
    assert steps == {(f"partition-{n}", n > 3, 13) for n in range(7)}
    with pytest.raises(ValueError, match="only STOPPED or FAILED"):
        resume_run(spark, out, new, references)


def test_ranges_written_but_not_committed_are_replaced(spark, references, tmp_path, monkeypatch):
    """The cut off ranges had rows in both files; those of the next attempt have none in one of them."""
    source, out = write_csv(tmp_path / "in.csv", many_lines(4)), str(tmp_path / "out")
    with monkeypatch.context() as patch:
        fail_on_call(patch, batch_run, "write_ranges", -2)
        with pytest.raises(RuntimeError):
            run_validation(spark, source, out, references, partitions=4, ranges_per_commit=1)
    run_id = run_log.read_runs(spark, out).first().run_id
    left = {p for p in paths(spark, out) if p[1] == 1}
    assert left and numbers(spark, out, RANGE) == [0]
    resume_run(spark, out, run_id, references, ranges_per_commit=3)
    assert ids(read_both_outputs(spark, out)) == expected_ids(4) and not left & paths(spark, out)


def test_only_completed_runs_are_read(spark, references, tmp_path, monkeypatch):
    source, out = write_csv(tmp_path / "in.csv", many_lines(3)), str(tmp_path / "out")
    run_validation(spark, source, out, references, partitions=3, ranges_per_commit=1, max_ranges=2)
    with monkeypatch.context() as patch:
        fail_on_call(patch, batch_run, "commit", 3)
        with pytest.raises(RuntimeError):
            run_validation(spark, source, out, references, partitions=3, ranges_per_commit=1)
    assert read_both_outputs(spark, out).count() == read_results(spark, out).count() == 0
    done = run_validation(spark, source, out, references, partitions=3)
    assert sorted(r.status for r in run_log.read_runs(spark, out).collect()) == ["COMPLETED", "FAILED", "STOPPED"]
    for rows in (read_both_outputs(spark, out), read_results(spark, out)):
        assert ids(rows) == expected_ids(3) and [r.run_id for r in rows.select("run_id").distinct().collect()] == [done]
    assert len({run for run, in spark.read.csv(f"{out}/valid").select("run_id").distinct().collect()}) == 3


def test_counts_are_those_of_the_written_rows(spark, references, tmp_path):
    lines = many_lines(5)
    for at in (3, 20, 21, 22):
        lines[at] = "broken,line"
    source, out = write_csv(tmp_path / "in.csv", lines), str(tmp_path / "out")
    run_validation(spark, source, out, references, partitions=6)
    written = label_ranges(read_results(spark, out), 6).groupBy("partition", "outcome").count().collect()
    found = {(r.partition, r.outcome): r["count"] for r in written}
    for row in read_commits(spark, out).filter(f"unit = '{RANGE}'").collect():
        own = [found.get((row.number, outcome), 0) for outcome in ("valid", "invalid", "quarantined")]
        assert [row.valid_count, row.invalid_count, row.skip_count] == own and row.read_count == sum(own)
    staged = read_commits(spark, out).filter(f"unit = '{STAGE}'").first()
    assert (staged.read_count, staged.skip_count) == (65, 4)


def test_ranges_are_labelled_without_a_shuffle(spark, references, tmp_path):
    out = str(tmp_path / "out")
    run_id = run_validation(spark, write_csv(tmp_path / "in.csv", LINES), out, references)
    plan = label_ranges(read_staged(spark, out, run_id), 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def slow(raw):
    """The standard mapper on rows that take a fifth of a second each."""
    from ledgersieve.operators.cleanse import cleanse

    return cleanse(raw.selectExpr("*", "java_method('java.lang.Thread', 'sleep', 200L) AS slept").filter("slept IS NOT NULL").drop("slept"))


def test_batch_run_is_stopped_by_id_from_another_session(spark, references, tmp_path):
    source, out, other = write_csv(tmp_path / "in.csv", many_lines(5)), str(tmp_path / "out"), spark.newSession()
    asked = []

    def ask():
        while not asked:
            time.sleep(0.3)
            if (tmp_path / "out" / "runs" / "_SUCCESS").exists():
                run = run_log.read_runs(other, out).first()
                run_log.request_stop(other, out, run.run_id)
                asked.append(run.run_id)

    thread = threading.Thread(target=ask)
    thread.start()
    begin = time.monotonic()
    run_id = run_validation(spark, source, out, references, mapper=slow, poll_seconds=0.2)
    thread.join()
    assert asked == [run_id] and time.monotonic() - begin < 11  # 13 seconds of sleep alone
    assert find_run(spark, out, run_id).status == "STOPPED" and read_both_outputs(spark, out).count() == 0
    assert spark.range(3).count() == 3  # later jobs of this thread are not cancelled
    with pytest.raises(ValueError, match="can be stopped"):
        run_log.request_stop(other, out, run_id)
    resume_run(spark, out, run_id, references)
    assert ids(read_both_outputs(spark, out)) == expected_ids(5)


def test_run_that_nobody_watches_cannot_be_stopped(spark, references, tmp_path):
    out = str(tmp_path / "out")
    run_log.append_state(spark, out, run_id="r", output_id="r", seq=1, status="STARTED", stoppable=False)
    with pytest.raises(ValueError, match="without looking at the log"):
        run_log.request_stop(spark, out, "r")
    run_log.append_state(spark, out, run_id="s", output_id="s", seq=1, status="STARTED", stoppable=True)
    assert not run_log.stop_is_requested(spark, out, "s")
    run_log.request_stop(spark, out, "s")
    assert run_log.stop_is_requested(spark, out, "s")
    run_id = run_validation(spark, write_csv(tmp_path / "in.csv", LINES), out, references, poll_seconds=None)
    assert find_run(spark, out, run_id).stoppable is False


def test_one_file_in_eight_chunks(spark, references, tmp_path):
    source, out = write_csv(tmp_path / "in.csv", many_lines(20)), str(tmp_path / "out")
    size = (tmp_path / "in.csv").stat().st_size // 8 + 1
    first = run_in_blocks(spark, source, out, references, chunk_bytes=size, max_chunks=3)
    assert find_run(spark, out, first).status == "STOPPED" and numbers(spark, out, CHUNK) == [0, 1, 2]
    blocks = read_blocks(spark, out, first).orderBy("line_block").collect()
    assert [b.chunk for b in blocks] == list(range(8)) and [b.line_block for b in blocks] == [size * i for i in range(8)]
    assert [b.first_line for b in blocks] == [sum(b.lines for b in blocks[:i]) for i in range(8)] and sum(b.lines for b in blocks) == 260
    some = ids(read_both_outputs(spark, out))
    assert some == expected_ids(20)[: len(some)] and len(some) == blocks[3].first_line  # committed chunks are read at once

    before = paths(spark, out)
    write_csv(tmp_path / "in.csv", LINES)  # the run goes on with the lines it began with
    second = resume_in_blocks(spark, first, out, references)
    assert find_run(spark, out, second).status == "COMPLETED" and before < paths(spark, out)
    assert ids(read_both_outputs(spark, out)) == expected_ids(20)
    errors = {(r.referenceId, r.validationErrors) for r in read_results(spark, out).collect()}
    assert errors == {(f"C{i:03}-{r[0][4:]}", r[-1]) for i in range(20) for r in GOLDEN}
    with pytest.raises(ValueError, match="only STOPPED or FAILED"):
        resume_in_blocks(spark, second, out, references)

    status = run_log.run_status(run_log.read_runs(spark, out), run_log.read_steps(spark, out), second).first()
    assert status.partitions is None and (status.progress.completed, status.progress.total_read) == (5, 260 - len(some))
    details = run_log.run_partitions(run_log.read_steps(spark, out), second).collect()
    assert [r.partition_name for r in details] == [f"partition-{n}" for n in range(3, 8)]


def test_block_run_over_files_is_cut_off_and_stopped(spark, references, tmp_path, monkeypatch):
    for i in range(3):
        write_csv(tmp_path / "in" / f"{i}.csv", [line.replace("C0", f"F{i}") for line in many_lines(4)])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    expected = sorted(name.replace("C0", f"F{i}") for i in range(3) for name in expected_ids(4))
    size = (tmp_path / "in" / "0.csv").stat().st_size * 2 // 5
    with monkeypatch.context() as patch:
        fail_on_call(patch, block_run, "write_chunk", -3)
        with pytest.raises(RuntimeError):
            run_in_blocks(spark, source, out, references, chunk_bytes=size)
    failed = run_log.read_runs(spark, out).first()
    assert failed.status == "FAILED" and numbers(spark, out, CHUNK) == [0, 1]
    assert read_both_outputs(spark, out).filter("partition > 1").count() == 0

    def stop_after_one(spark, output, output_id, run_id, *rest):
        commit(spark, output, output_id, run_id, *rest)
        run_log.request_stop(spark, output, run_id)

    with monkeypatch.context() as patch:
        patch.setattr(block_run, "commit", stop_after_one)
        stopped = resume_in_blocks(spark, failed.run_id, out, references)
    assert find_run(spark, out, stopped).status == "STOPPED" and numbers(spark, out, CHUNK) == [0, 1, 2]
    resume_in_blocks(spark, stopped, out, references)
    assert ids(read_both_outputs(spark, out)) == expected


def test_block_run_without_lines(spark, references, tmp_path):
    out = str(tmp_path / "out")
    run_id = run_in_blocks(spark, write_csv(tmp_path / "in.csv", []), out, references)
    assert find_run(spark, out, run_id).status == "COMPLETED" and read_both_outputs(spark, out).count() == 0


def test_blocks_do_not_depend_on_the_files_read_together(spark, tmp_path, conf):
    for name, copies in (("a", 9), ("b", 2), ("c", 30)):
        write_csv(tmp_path / "in" / f"{name}.csv", many_lines(copies))
    conf(spark__sql__files__maxPartitionBytes="77")
    with block_size(spark, 5000):
        alone = file_blocks(scan_transactions(spark, str(tmp_path / "in" / "c.csv")), 10**9).collect()
        among = file_blocks(scan_transactions(spark, str(tmp_path / "in")), 10**9).filter("line_file LIKE '%c.csv'").collect()
    assert sorted(b.line_block for b in among) == sorted(b.line_block for b in alone) == list(range(0, among[0].line_block + 5000 * len(among), 5000))[: len(alone)]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "77"


def test_lines_of_files(spark, references, tmp_path):
    texts = {
        "plain": [HEADER, *LINES, ""], "blank": [HEADER, "", LINES[0], " \t", LINES[1], "", ""], "header": [HEADER],
        "late": ["", "  ", HEADER, LINES[0], ""], "empty": [""] * 4, "open": [HEADER, LINES[0]],
    }
    for name, lines in texts.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.csv").write_text("\n".join(lines), encoding="utf-8")
    found = {r.line_file.rsplit("/", 1)[1][:-4]: (r.lines, r.left_out) for r in count_lines(spark, str(tmp_path / "in")).collect()}
    assert found == {"plain": (13, 0), "blank": (5, 3), "header": (0, 0), "late": (3, 2), "empty": (2, 2), "open": (1, 0)}
    out = str(tmp_path / "out")
    run_id = run_validation(spark, str(tmp_path / "in"), out, references, physical_lines=True)
    run = find_run(spark, out, run_id)
    read = read_commits(spark, out).filter(f"unit = '{STAGE}'").first().read_count
    assert (run.line_count, run.left_out, read) == (24, 7, 17)
