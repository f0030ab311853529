"""Command line: generate input, start, resume and inspect runs.

    python -m ledgersieve generate --rows 100000 --out data/transactions
    python -m ledgersieve start --input data/transactions --output data/out
    python -m ledgersieve stop --output data/out --run ID
    python -m ledgersieve status --output data/out [--run ID]
    python -m ledgersieve summary --output data/out

On a cluster the same arguments go to spark-submit with this file.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgersieve.fixed_values import DEFAULT_INVALID_RATE
from ledgersieve.plans import reports, run_log
from ledgersieve.plans.batch_run import find_run, resume_run, run_validation
from ledgersieve.plans.outputs import MOST_RANGES, read_both_outputs, read_output
from ledgersieve.plans.validation import References
from ledgersieve.session import build_session
from ledgersieve.sources.dimensions import read_accounts, read_banks, read_limits
from ledgersieve.sources.generated import generate_range
from ledgersieve.sources.transactions import write_transaction_files
from ledgersieve.streaming.block_run import resume_in_blocks, run_in_blocks
from ledgersieve.streaming.chunked_run import ChunkedRun


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.action(spark or build_session(), args)


def _generate(spark, args):
    write_transaction_files(generate_range(spark, args.rows, invalid_rate=args.invalid_rate, seed=args.seed), args.out)


def _start(spark, args):
    references = _references(spark, args)
    if args.max_files:
        run = ChunkedRun.start(spark, args.input, args.output, references, max_files=args.max_files)
        print(run.run_id, run.wait())
    elif args.chunk_bytes:
        _print_state(spark, args, run_in_blocks(spark, args.input, args.output, references, chunk_bytes=args.chunk_bytes))
    else:
        ranges = {"partitions": args.partitions} if args.partitions else {}
        print(run_validation(
            spark, args.input, args.output, references, ranges_per_commit=args.ranges_per_commit,
            physical_lines=args.physical_lines, **ranges,
        ))


def _resume(spark, args):
    references = _references(spark, args)
    if args.max_files:
        run = ChunkedRun.resume(spark, args.run, args.output, references, max_files=args.max_files)
        print(run.run_id, run.wait())
    elif args.chunk_bytes:
        _print_state(spark, args, resume_in_blocks(spark, args.run, args.output, references, chunk_bytes=args.chunk_bytes))
    else:
        print(resume_run(
            spark, args.output, args.run, references, partitions=args.partitions,
            ranges_per_commit=args.ranges_per_commit, physical_lines=args.physical_lines,
        ))


def _print_state(spark, args, run_id: str) -> None:
    print(run_id, find_run(spark, args.output, run_id).status)


def _status(spark, args):
    runs = run_log.read_runs(spark, args.output)
    if args.run:
        run_log.run_status(runs, run_log.read_steps(spark, args.output), args.run).show(truncate=False, vertical=True)
    else:
        _print(run_log.runs_latest(run_log.with_elapsed(runs)).select(
            "run_id", "status", "elapsed", "input_path", "resumed_from"
        ))


def _stop(spark, args):
    run_log.request_stop(spark, args.output, args.run)
    print(args.run, run_log.STOPPING)


def _print(report) -> None:
    """All rows of a report, fetched part by part."""
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _summary(spark, args):
    _print(reports.output_counts(read_both_outputs(spark, args.output)).orderBy("outcome", "partition"))
    invalid = read_output(spark, args.output, "invalid")
    _print(reports.errors_by_type(invalid))
    _print(reports.error_histogram(invalid))


def _references(spark, args) -> References:
    """The seeded tables, each replaced by a file if one is given."""
    seeded = References.seeded(spark)
    return References(
        read_banks(spark, args.banks) if args.banks else seeded.banks,
        read_limits(spark, args.limits) if args.limits else seeded.limits,
        read_accounts(spark, args.accounts) if args.accounts else seeded.accounts,
    )


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgersieve")
    commands = parser.add_subparsers(required=True)

    def command(name, action, *options):
        sub = commands.add_parser(name)
        sub.set_defaults(action=action)
        for flags, settings in options:
            sub.add_argument(flags, **settings)

    output, run = ("--output", {"required": True}), ("--run", {"required": True})
    run_options = (
        ("--partitions", {"type": int, "help": "ranges of lines that the outputs are split into"}),
        ("--ranges-per-commit", {"type": int, "default": MOST_RANGES, "help": "ranges that are written and committed together"}),
        ("--physical-lines", {"action": "store_true", "help": "also log the lines of the files and how many are no data"}),
        ("--max-files", {"type": int, "help": "work in chunks of so many files"}),
        ("--chunk-bytes", {"type": int, "help": "work in chunks of lines of about so many bytes, also within files"}),
        ("--banks", {"help": "CSV with code, name, ord"}),
        ("--limits", {"help": "CSV with transactionType, minAmount, maxAmount, currency, ord"}),
        ("--accounts", {"help": "parquet with accountNumber, accountName, bankCode, status"}),
    )
    command(
        "generate", _generate,
        ("--rows", {"type": int, "default": 100_000}), ("--out", {"required": True}),
        ("--invalid-rate", {"type": float, "default": DEFAULT_INVALID_RATE}), ("--seed", {"type": int, "default": 0}),
    )
    command("start", _start, ("--input", {"required": True}), output, *run_options)
    command("resume", _resume, run, output, *run_options)
    command("stop", _stop, run, output)
    command("status", _status, output, ("--run", {}))
    command("summary", _summary, output)
    return parser


if __name__ == "__main__":
    main()
