"""The four stand-alone validators: bank code, amount, account, and accounts in bulk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import (
    ABOVE_REASON, BELOW_REASON, MAX_BULK_ACCOUNTS, NOT_FOUND_REASON, STATUS_ACTIVE, STATUS_NOT_FOUND,
    STATUS_REASON, TYPE_REASON,
)
from ..functions.amounts import above, below, with_amount
from ..functions.text import clean_text, fill, is_blank
from .lookups import join_account, join_bank, join_limit


def validate_bank_codes(df: DataFrame, banks: DataFrame, code: str) -> DataFrame:
    """Replaces the given column by ``code`` (as listed, else as given), ``valid`` and ``name``."""
    given = df.withColumnRenamed(code, "_given")
    return join_bank(given, banks, "_given", "_bank_").selectExpr(
        *[c for c in df.columns if c != code],
        "coalesce(_bank_code, _given) AS code",
        "_bank_known AS valid",
        "_bank_name AS name",
    )


def amount_reason(transaction_type: str, amount: str, text: str, rest: str, prefix: str) -> str:
    """SQL: why an amount is not acceptable, or null; for rows joined by ``join_limit``."""
    return f"""CASE
        WHEN {prefix}type_key IS NULL THEN {fill(TYPE_REASON, transaction_type)}
        WHEN {below(amount, rest, prefix + 'min_amount')}
            THEN {fill(BELOW_REASON, text, prefix + 'min_text', transaction_type)}
        WHEN {above(amount, rest, prefix + 'max_amount')}
            THEN {fill(ABOVE_REASON, text, prefix + 'max_text', transaction_type)}
        END"""


def validate_amounts(df: DataFrame, limits: DataFrame, transaction_type: str, amount: str) -> DataFrame:
    """Replaces the amount text by its number and adds ``amount_text``, ``valid`` and ``reason``.

    ``amount_text`` is the exact number as printed; the number is null if it has more than
    20 digits before the point. Checked in this order: type unknown, below the minimum, above the maximum.
    Both bounds are inclusive.
    """
    written = df.withColumn("_written", F.expr(clean_text(f"CAST({amount} AS STRING)"))).drop(amount)
    typed = with_amount(written, "_written", amount, "amount_text", "_rest")
    reason = amount_reason(transaction_type, amount, "amount_text", "_rest", "_limit_")
    return join_limit(typed, limits, transaction_type, "_limit_").selectExpr(
        *df.columns, "amount_text", f"{reason} AS reason"
    ).selectExpr(*df.columns, "amount_text", "reason IS NULL AS valid", "reason")


def validate_accounts(df: DataFrame, accounts: DataFrame, number: str, bank: str) -> DataFrame:
    """Replaces number and bank by accountNumber, bankCode, accountName, valid, status and reason.

    Number and bank are those of the table if the account is found, else as given.
    """
    active = f"(_acct_found AND {is_active('_acct_status')})"
    return join_account(df, accounts, number, bank, "_acct_").selectExpr(
        *[c for c in df.columns if c not in (number, bank)],
        f"{number} AS accountNumber",
        f"coalesce(_acct_bankCode, {bank}) AS bankCode",
        "_acct_accountName AS accountName",
        f"{active} AS valid",
        f"IF(_acct_found, upper(_acct_status), '{STATUS_NOT_FOUND}') AS status",
        f"""CASE WHEN NOT _acct_found THEN {fill(NOT_FOUND_REASON, number, bank)}
                 WHEN NOT {active} THEN {fill(STATUS_REASON, '_acct_status')} END AS reason""",
    )


def is_active(status: str) -> str:
    return f"(upper({status}) = '{STATUS_ACTIVE}')"


def has_blank_field(*fields: str) -> str:
    """SQL: true if a required field is missing, empty or only white space."""
    return f"({' OR '.join(is_blank(field) for field in fields)})"


def validate_accounts_in_bulk(
    requests: DataFrame, accounts: DataFrame, batch: str, position: str, number: str, bank: str
) -> DataFrame:
    """One row per batch: accepted, totalRequested, totalValid, totalInvalid, results.

    A batch is accepted if it has 1 to 100 entries and no blank field; a refused one has
    only ``totalRequested``. ``results`` is ordered by ``position``, which may start
    anywhere, have gaps and repeat.

    The contract is checked first, by an aggregate that holds two numbers per batch.
    Only entries of accepted batches are looked up and gathered, at most 100 each.
    """
    batches = check_batches(requests, batch, number, bank)
    accepted = batches.filter("accepted").select(F.col(batch).alias("_batch"))
    entries = requests.join(accepted, F.col(batch).eqNullSafe(F.col("_batch")), "left_semi")
    fields = ("accountNumber", "bankCode", "accountName", "valid", "status", "reason")
    entry = f"struct({position} AS position, {', '.join(fields)})"
    gathered = validate_accounts(entries, accounts, number, bank).groupBy(F.col(batch).alias("_batch")).agg(
        F.expr("count_if(valid) AS _valid"), F.expr(f"array_sort(collect_list({entry})) AS results")
    )
    return batches.join(gathered, F.col(batch).eqNullSafe(F.col("_batch")), "left").selectExpr(
        batch,
        "accepted",
        "size AS totalRequested",
        "_valid AS totalValid",
        "size - _valid AS totalInvalid",
        "results",
    )


def batch_is_accepted(size: str, blank_entries: str) -> str:
    return f"({size} BETWEEN 1 AND {MAX_BULK_ACCOUNTS} AND {blank_entries} = 0)"


def check_batches(requests: DataFrame, batch: str, number: str, bank: str) -> DataFrame:
    """Size and contract of each batch, without looking anything up."""
    sizes = requests.groupBy(batch).agg(
        F.expr("count(*) AS size"), F.expr(f"count_if({has_blank_field(number, bank)}) AS blank_entries")
    )
    return sizes.withColumn("accepted", F.expr(batch_is_accepted("size", "blank_entries")))
