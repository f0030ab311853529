"""The named queries. Each takes (spark, folder of the given tables) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import schemas
from ..fixed_values import CSV_HEADER, INVALID_OUTPUT_FIELDS, NO_RESULT_ERROR, TRANSACTION_FIELDS
from ..functions.amounts import with_amount
from ..functions.text import case_key, clean_text
from ..operators.cleanse import cleanse
from ..operators.lookups import (
    join_account, join_bank, limit_by_type, rows_with_known_account, rows_with_unknown_bank,
)
from ..operators.ranges import label_ranges, range_bounds, range_split
from ..operators.reconcile import reconcile, remaining_rows
from ..operators.rules import count_rule_hits
from ..operators.validators import (
    check_batches, validate_accounts, validate_accounts_in_bulk, validate_amounts, validate_bank_codes,
)
from ..plans import reports, run_log
from ..plans.batch_run import find_run, resume_run, run_validation
from ..plans.commits import RANGE, read_commits
from ..plans.outputs import part_files, read_both_outputs, read_results, select_output, stage_results
from ..plans.validation import References, check_lines, look_up, transaction_rules, validate_transactions
from ..session import new_work_dir, staged_table
from ..sources.dimensions import (
    duplicate_accounts, first_wins, local_table, seeded_accounts, seeded_banks, seeded_limits,
)
from ..sources.generated import generate_transactions
from ..sources.transactions import scan_transactions, with_line_id, write_transaction_files
from ..streaming.block_run import resume_in_blocks, run_in_blocks
from ..streaming.chunked_run import ChunkedRun
from .given_tables import (
    customer_accounts, customer_references, customer_transactions, nation_banks, order_ids, order_run_steps,
    order_runs, order_transactions, priority_limits, table,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

_CHECKED = (*TRANSACTION_FIELDS, "amount_text", "valid", "validationErrors", "amount_reason")
_PAIR = (("source", "sourceAccount", "sourceBankCode"), ("beneficiary", "beneficiaryAccount", "beneficiaryBankCode"))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


# --- shared inputs ----------------------------------------------------------


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse(order_transactions(spark, folder).drop("id"))


def _transfers(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse(customer_transactions(spark, folder))


def _checked_transfers(spark: SparkSession, folder: str) -> DataFrame:
    return validate_transactions(_transfers(spark, folder), customer_references(spark, folder))


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return validate_transactions(_clean(spark, folder), References.seeded(spark))


def _invalid(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).filter(~F.col("valid"))


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The result rows written once, as a batch run does; both outputs are projections of them."""
    lines = with_line_id(scan_transactions(spark, _transaction_files(spark, folder)))
    results = check_lines(lines, customer_references(spark, folder))
    return stage_results(results, new_work_dir(spark, "results"), "orders")


def _sides(clean: DataFrame) -> DataFrame:
    """Two rows per transaction: referenceId, side, account, bank."""
    sides = ", ".join(
        f"struct('{side}' AS side, {account} AS account, {bank} AS bank)" for side, account, bank in _PAIR
    )
    return clean.selectExpr("referenceId", f"inline(array({sides}))")


def _transaction_files(spark: SparkSession, folder: str, files: int = 8) -> str:
    """Writes the customers' transfers as CSV files in the order of their keys, and returns the folder.

    The last of ``files`` files is shorter than the others.
    """
    path = new_work_dir(spark, "transactions")
    rows_per_file = max(1, ceil(order_ids(spark, folder).count() / (files - 0.5)))
    in_order = customer_transactions(spark, folder).withColumn("_key", F.expr("CAST(substring(referenceId, 5) AS BIGINT)"))
    write_transaction_files(in_order.orderBy("_key"), path, rows_per_file)
    return path


def _bulk_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Source accounts in batches: a third of all rows are one far too large batch, all at one position.

    In the other batches positions start at 1 and have gaps.
    """
    return order_transactions(spark, folder).selectExpr(
        "IF(id % 3 = 0, -1L, id div 60) AS batch_id",
        "IF(id % 3 = 0, 7L, id % 60 * 5 + 1) AS position",
        f"{clean_text('sourceAccount')} AS account",
        f"{clean_text('sourceBankCode')} AS bank",
    )


# --- sources ----------------------------------------------------------------


@_query("scan_transactions")
def scan_transactions_csv(spark: SparkSession, folder: str) -> DataFrame:
    return scan_transactions(spark, _transaction_files(spark, folder)).select(*TRANSACTION_FIELDS)


@_query("list_bank_codes")
def list_bank_codes(spark: SparkSession, folder: str) -> DataFrame:
    return nation_banks(spark, folder).select("code", "name")


@_query("list_limits")
def list_limits(spark: SparkSession, folder: str) -> DataFrame:
    return priority_limits(spark, folder).select("transactionType", "minAmount", "maxAmount", "currency")


@_query("list_accounts")
def list_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return customer_accounts(spark, folder)


@_query("gen_transactions")
def gen_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return generate_transactions(order_ids(spark, folder)).select(*TRANSACTION_FIELDS, "fault")


@_query("fault_mix")
def fault_mix(spark: SparkSession, folder: str) -> DataFrame:
    made = generate_transactions(order_ids(spark, folder), invalid_rate=0.25, seed=11)
    return made.groupBy("fault").agg(F.count("*").alias("n"))


# --- projections ------------------------------------------------------------


@_query("cleanse_transactions")
def cleanse_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(*TRANSACTION_FIELDS, "amount_text", "valid", "validationErrors")


@_query("parse_amount")
def parse_amount(spark: SparkSession, folder: str) -> DataFrame:
    """Ways of writing a number made from the order key."""
    forms = (
        "n", "concat('+', n)", "concat('000', n, '.50')", "concat('.', n)", "concat(n, '.')", "concat(n, 'e3')",
        "concat('abc', n)", "concat('-', n)", "concat('0.0000000', n)", "concat(n, repeat('0', 20))",
        "concat(n, '.', repeat('0', 18), '1')",
    )
    cases = " ".join(f"WHEN {number} THEN {form}" for number, form in enumerate(forms))
    named = order_ids(spark, folder).withColumn("n", F.expr("CAST(id + 1 AS STRING)"))
    rows = named.selectExpr("id", f"CASE id % {len(forms)} {cases} END AS written")
    return with_amount(rows, "written", "amount", "amount_text", "amount_rest")


@_query("account_key")
def account_key(spark: SparkSession, folder: str) -> DataFrame:
    keys = [f"concat({account}, ':', {case_key(bank)}) AS {side}_key" for side, account, bank in _PAIR]
    return _clean(spark, folder).selectExpr("referenceId", *keys)


# --- lookups ----------------------------------------------------------------


@_query("join_source_bank")
def join_source_bank(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_bank(_transfers(spark, folder), nation_banks(spark, folder), "sourceBankCode", "bank_")
    return joined.select("referenceId", "sourceBankCode", "bank_name", "bank_known")


@_query("join_beneficiary_bank")
def join_beneficiary_bank(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_bank(_transfers(spark, folder), nation_banks(spark, folder), "beneficiaryBankCode", "bank_")
    return joined.select("referenceId", "beneficiaryBankCode", "bank_name", "bank_known")


@_query("join_source_account")
def join_source_account(spark: SparkSession, folder: str) -> DataFrame:
    clean = _transfers(spark, folder)
    joined = join_account(clean, customer_accounts(spark, folder), "sourceAccount", "sourceBankCode", "account_")
    return joined.select("referenceId", "sourceAccount", "account_accountName", "account_status", "account_found")


@_query("join_beneficiary_account")
def join_beneficiary_account(spark: SparkSession, folder: str) -> DataFrame:
    clean = _transfers(spark, folder)
    joined = join_account(clean, customer_accounts(spark, folder), "beneficiaryAccount", "beneficiaryBankCode", "account_")
    return joined.select(
        "referenceId", "beneficiaryAccount", "account_accountName", "account_status", "account_found"
    )


@_query("same_account_override")
def same_account_override(spark: SparkSession, folder: str) -> DataFrame:
    looked_up = look_up(_transfers(spark, folder), customer_references(spark, folder))
    return looked_up.selectExpr(
        "referenceId", "sourceAccount = beneficiaryAccount AS same_account", "sourceBankCode", "beneficiaryBankCode",
        "source_status", "beneficiary_status",
    )


@_query("limit_by_type")
def limit_of_type(spark: SparkSession, folder: str) -> DataFrame:
    return limit_by_type(priority_limits(spark, folder), "2-high")


@_query("unknown_banks_anti")
def unknown_banks_anti(spark: SparkSession, folder: str) -> DataFrame:
    sides = _sides(_transfers(spark, folder))
    return rows_with_unknown_bank(sides, nation_banks(spark, folder), "bank").select("referenceId", "side", "bank")


@_query("known_accounts_semi")
def known_accounts_semi(spark: SparkSession, folder: str) -> DataFrame:
    sides = _sides(_transfers(spark, folder))
    return rows_with_known_account(sides, customer_accounts(spark, folder), "account", "bank").select(
        "referenceId", "side", "account"
    )


# --- validators -------------------------------------------------------------


@_query("validate_bank_code")
def validate_bank_code(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate_bank_codes(_sides(_transfers(spark, folder)), nation_banks(spark, folder), "bank")
    return checked.select("referenceId", "side", "code", "valid", "name")


@_query("validate_amount")
def validate_amount(spark: SparkSession, folder: str) -> DataFrame:
    requests = order_transactions(spark, folder).selectExpr(
        *[f"{clean_text(c)} AS {c}" for c in ("referenceId", "transactionType")], "amount"
    )
    return validate_amounts(requests, seeded_limits(spark), "transactionType", "amount")


@_query("validate_account")
def validate_account(spark: SparkSession, folder: str) -> DataFrame:
    return validate_accounts(_sides(_transfers(spark, folder)), customer_accounts(spark, folder), "account", "bank")


@_query("bulk_account_summary")
def bulk_account_summary(spark: SparkSession, folder: str) -> DataFrame:
    bulk = validate_accounts_in_bulk(
        _bulk_requests(spark, folder), seeded_accounts(spark), "batch_id", "position", "account", "bank"
    )
    line = lambda r: F.concat_ws(":", r["accountNumber"], r["bankCode"], r["status"])
    text = F.when(F.col("accepted"), F.concat_ws("|", F.transform("results", line)))
    return bulk.withColumn("results", text)


@_query("contract_batch_size")
def contract_batch_size(spark: SparkSession, folder: str) -> DataFrame:
    return check_batches(_bulk_requests(spark, folder), "batch_id", "account", "bank")


@_query("contract_blank_fields")
def contract_blank_fields(spark: SparkSession, folder: str) -> DataFrame:
    failing = reports.rows_with_error(_invalid(spark, folder), NO_RESULT_ERROR)
    return failing.select("referenceId", *[c for _, *pair in _PAIR for c in pair], "validationErrors")


@_query("validate_transactions")
def validate_transactions_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).select(*_CHECKED)


@_query("validate_transactions_customers")
def validate_transactions_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _checked_transfers(spark, folder).select(*_CHECKED)


@_query("rule_hits")
def rule_hits(spark: SparkSession, folder: str) -> DataFrame:
    looked_up = look_up(_transfers(spark, folder), customer_references(spark, folder))
    return count_rule_hits(looked_up, transaction_rules())


# --- outputs ----------------------------------------------------------------


@_query("valid_output")
def valid_output(spark: SparkSession, folder: str) -> DataFrame:
    return select_output(_stored(spark, folder), "valid")


@_query("invalid_output")
def invalid_output(spark: SparkSession, folder: str) -> DataFrame:
    return select_output(_stored(spark, folder), "invalid")


@_query("written_outputs")
def written_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """A whole batch run from files to files, read back with the partition of each line."""
    output = new_work_dir(spark, "batch")
    run_validation(spark, _transaction_files(spark, folder), output, customer_references(spark, folder))
    return read_both_outputs(spark, output).drop("run_id")


@_query("stream_validate")
def stream_validate(spark: SparkSession, folder: str) -> DataFrame:
    """A whole chunked run, stopped after its first chunk and resumed."""
    source = _transaction_files(spark, folder)
    output, references = new_work_dir(spark, "chunked"), customer_references(spark, folder)
    run = ChunkedRun.start(spark, source, output, references, max_files=3, max_chunks=1)
    if run.wait() == "STOPPED":
        ChunkedRun.resume(spark, run.run_id, output, references).wait()
    return read_results(spark, output).select(*TRANSACTION_FIELDS, "validationErrors", "outcome")


@_query("resumed_ranges")
def resumed_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A batch run that ends after four of its ranges and is resumed: all lines, with the execution that has
    written each range and whether the range's files are those from before the resumption."""
    output, references = new_work_dir(spark, "batch"), customer_references(spark, folder)
    first = run_validation(
        spark, _transaction_files(spark, folder), output, references, partitions=7, ranges_per_commit=1, max_ranges=4
    )
    before = staged_table(part_files(spark, output), "part_files")
    if find_run(spark, output, first).status == "STOPPED":
        resume_run(spark, output, first, references, ranges_per_commit=2)
    kept = part_files(spark, output).join(before.select("path", F.lit(True).alias("old")), "path", "left")
    parts = kept.groupBy("outcome", "partition").agg(F.every(F.coalesce("old", F.lit(False))).alias("files_kept"))
    execution = F.when(F.col("run_id") == first, 1).otherwise(2).alias("execution")
    ranges = read_commits(spark, output).filter(F.col("unit") == RANGE).select(F.col("number").alias("partition"), execution)
    return read_both_outputs(spark, output).drop("run_id").join(parts, ["outcome", "partition"]).join(ranges, "partition")


@_query("committed_outputs")
def committed_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over the same lines: one stopped after some ranges, one failed, one completed. Only the last is read."""
    source, output, references = _transaction_files(spark, folder), new_work_dir(spark, "batch"), customer_references(spark, folder)
    run_validation(spark, source, output, references, ranges_per_commit=3, max_ranges=3)
    unreadable = local_table(spark, schemas.LIMITS, [("1-URGENT", "no number", "1", "IDR", 0)])
    try:
        run_validation(spark, source, output, References(references.banks, unreadable, references.accounts))
    except Exception as error:
        if "no number" not in str(error):
            raise
    run_validation(spark, source, output, references)
    states = run_log.read_runs(spark, output).select("status").agg(F.array_join(F.sort_array(F.collect_list("status")), " ")).first()[0]
    return read_both_outputs(spark, output).drop("run_id").withColumn("states", F.lit(states))


@_query("block_chunks")
def block_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """A run in some eight chunks of lines within three files, ended after three chunks and resumed."""
    source, output, references = _transaction_files(spark, folder, 3), new_work_dir(spark, "blocks"), customer_references(spark, folder)
    size = spark.read.format("binaryFile").load(source).agg(F.sum("length")).first()[0]
    run_id = run_in_blocks(spark, source, output, references, chunk_bytes=size // 8 + 1, max_chunks=3)
    if find_run(spark, output, run_id).status == "STOPPED":
        resume_in_blocks(spark, run_id, output, references)
    return read_results(spark, output).select(*TRANSACTION_FIELDS, "validationErrors", "outcome")


@_query("line_accounting")
def line_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """A run over files with blank lines: lines of the files, those left out, and what became of the others."""
    fields = ", ".join(f"coalesce({f}, '')" for f in TRANSACTION_FIELDS if f != "note")
    numbered = customer_transactions(spark, folder).selectExpr(
        "CAST(substring(referenceId, 5) AS BIGINT) AS k", f"concat_ws(',', {fields}) AS line"
    )
    blank = """CASE k % 5 WHEN 0 THEN array(line, '') WHEN 1 THEN array(' \t ', line) WHEN 2 THEN array('too,short')
        ELSE array(line) END"""
    lines = numbered.selectExpr("k div 20000 AS file", "k", f"posexplode({blank}) AS (place, value)")
    headers = lines.select("file").distinct().selectExpr("file", "-1L AS k", "0 AS place", f"'{','.join(CSV_HEADER)}' AS value")
    source, output = new_work_dir(spark, "lines"), new_work_dir(spark, "batch")
    in_order = headers.unionByName(lines).repartition("file").sortWithinPartitions("file", "k", "place")
    in_order.select("file", "value").write.partitionBy("file").text(source)
    run_id = run_validation(
        spark, source, output, customer_references(spark, folder), physical_lines=True, recursiveFileLookup="true"
    )
    progress = run_log.run_progress(run_log.read_steps(spark, output))
    run = run_log.read_runs(spark, output).filter(F.col("run_id") == run_id).select("run_id", "line_count", "left_out")
    return run.join(progress, "run_id").select("line_count", "left_out", "total_read", "total_written", "total_skipped")


@_query("output_counts")
def output_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counted in the parts that a run has written."""
    output = new_work_dir(spark, "batch")
    run_validation(spark, _transaction_files(spark, folder), output, customer_references(spark, folder))
    return reports.output_counts(read_both_outputs(spark, output))


@_query("logged_run")
def logged_run(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a real run over lines that are good, quoted, without note, or have a field too many or too few."""
    fields = ", ".join(f"coalesce({f}, '')" for f in TRANSACTION_FIELDS if f != "note")
    whole = f"concat_ws(',', {fields})"
    lines = customer_transactions(spark, folder).withColumn("k", F.expr("CAST(substring(referenceId, 5) AS BIGINT)")).select(
        "k",
        F.expr(f"""CASE k % 10 WHEN 1 THEN {whole} WHEN 2 THEN concat({whole}, ',a note,one more')
            WHEN 3 THEN concat({whole}, ',"a note, quoted"') WHEN 4 THEN concat_ws(',', referenceId, sourceAccount)
            ELSE concat({whole}, ',a note') END""").alias(",".join(CSV_HEADER)),
    )
    source, output = new_work_dir(spark, "lines"), new_work_dir(spark, "batch")
    rows_per_file = max(1, ceil(order_ids(spark, folder).count() / 7.5))
    in_order = lines.orderBy("k").drop("k")
    in_order.write.options(header="true", sep="\u0001", quote="", maxRecordsPerFile=rows_per_file).csv(source)
    run_id = run_validation(spark, source, output, customer_references(spark, folder))
    status = run_log.run_status(run_log.read_runs(spark, output), run_log.read_steps(spark, output), run_id)
    totals = status.select(F.col("status").alias("run_status"), "progress.*", "partitions")
    return totals.select(
        "run_status", "total_read", "total_written", "total_skipped", F.explode("partitions").alias("p")
    ).select(
        "run_status", "total_read", "total_written", "total_skipped", "p.partition_name", "p.read_count",
        "p.write_count", "p.skip_count",
    )


@_query("reconcile_outputs")
def reconcile_outputs(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, folder)
    outputs = [select_output(stored, outcome) for outcome in ("valid", "invalid")]
    return reconcile(_transfers(spark, folder), *outputs)


@_query("resume_anti_join")
def resume_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """What is left if the finished orders were written before a stop."""
    finished = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    written = finished.select(F.format_string("TRX-%07d", "o_orderkey").alias("referenceId"))
    return remaining_rows(_clean(spark, folder), written, ["referenceId"]).select("referenceId", "sourceAccount")


# --- summaries --------------------------------------------------------------


@_query("validity_totals")
def validity_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.validity_totals(_checked_transfers(spark, folder))


@_query("input_count")
def input_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.input_count(scan_transactions(spark, _transaction_files(spark, folder)))


@_query("errors_by_type")
def errors_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.errors_by_type(_invalid(spark, folder))


@_query("error_histogram")
def error_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return reports.error_histogram(_checked_transfers(spark, folder).filter(~F.col("valid")))


@_query("preview_invalid")
def preview_invalid(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.col("amount_text").alias(c) if c == "amount" else c for c in INVALID_OUTPUT_FIELDS]
    rank = F.row_number().over(Window.orderBy("referenceId")).alias("rank")  # of the few rows of a preview
    return reports.preview(_invalid(spark, folder)).select(*columns, rank)


# --- run log ----------------------------------------------------------------


@_query("run_progress")
def run_progress(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.run_progress(order_run_steps(spark, folder))


@_query("run_partitions")
def run_partitions(spark: SparkSession, folder: str) -> DataFrame:
    steps = run_log.run_partitions(order_run_steps(spark, folder), 1)
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("partition_name"))
    return steps.withColumns({c: F.col(c).cast("string") for c in ("start_time", "end_time")} | {"rank": place})


@_query("runs_latest")
def runs_latest(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.runs_latest(order_runs(spark, folder)).select("run_id", "status")


@_query("stoppable_runs")
def stoppable_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.stoppable_runs(order_runs(spark, folder)).select("run_id", "status")


@_query("restartable_runs")
def restartable_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.restartable_runs(order_runs(spark, folder)).select("run_id", "status")


@_query("run_elapsed")
def run_elapsed(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    return run_log.with_elapsed(order_runs(spark, folder), now).select("run_id", "elapsed")


# --- ranges and keys --------------------------------------------------------


@_query("range_split")
def range_split_orders(spark: SparkSession, folder: str) -> DataFrame:
    return range_split(order_ids(spark, folder), ["id"], 7)


@_query("range_bounds")
def range_bounds_orders(spark: SparkSession, folder: str) -> DataFrame:
    """First and last line of each range of a run's stored lines."""
    return range_bounds(label_ranges(_stored(spark, folder), 7))


@_query("dim_first_wins")
def dim_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.expr(f"{case_key('c_mktsegment')} AS segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("ord")
    )
    return first_wins(customers, ["segment"], "ord")


@_query("duplicate_accounts")
def duplicate_account_keys(spark: SparkSession, folder: str) -> DataFrame:
    accounts = table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("string").alias("accountNumber"), F.lower("c_mktsegment").alias("bankCode")
    )
    return duplicate_accounts(accounts)
