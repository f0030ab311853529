"""Left joins that look a transaction's keys up in a reference table.

Each adds columns under a prefix and keeps exactly the rows it is given: the
looked-up frames have one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import case_key, quoted
from ..sources.dimensions import account_lookup, bank_lookup, first_wins, limit_lookup


def join_bank(df: DataFrame, banks: DataFrame, code: str, prefix: str) -> DataFrame:
    """Adds {prefix}code, {prefix}name and {prefix}known for a bank code, compared without case."""
    return attach_bank(df, bank_lookup(banks), code, prefix).selectExpr(
        *df.columns, f"{prefix}code", f"{prefix}name", f"{prefix}bank_key IS NOT NULL AS {prefix}known"
    )


def join_limit(df: DataFrame, limits: DataFrame, transaction_type: str, prefix: str) -> DataFrame:
    """Adds the limit columns of a transaction type, compared without case; null if there is none."""
    return attach_limit(df, limit_lookup(limits), transaction_type, prefix)


def join_account(df: DataFrame, accounts: DataFrame, number: str, bank: str, prefix: str) -> DataFrame:
    """Adds {prefix}accountName, {prefix}bankCode, {prefix}status and {prefix}found."""
    return attach_account(df, account_lookup(accounts), number, bank, prefix).selectExpr(
        *df.columns,
        f"{prefix}accountName",
        f"{prefix}bankCode",
        f"{prefix}status",
        f"{prefix}account_key IS NOT NULL AS {prefix}found",
    )


def attach_bank(df: DataFrame, lookup: DataFrame, code: str, prefix: str) -> DataFrame:
    """The bare join with a ``bank_lookup``; its key is null where there is no match."""
    return df.join(_prefixed(lookup, prefix), F.expr(f"{case_key(code)} = {prefix}bank_key"), "left")


def attach_limit(df: DataFrame, lookup: DataFrame, transaction_type: str, prefix: str) -> DataFrame:
    return df.join(_prefixed(lookup, prefix), F.expr(f"{case_key(transaction_type)} = {prefix}type_key"), "left")


def attach_account(df: DataFrame, lookup: DataFrame, number: str, bank: str, prefix: str) -> DataFrame:
    match = f"{number} = {prefix}account_key AND {case_key(bank)} = {prefix}account_bank_key"
    return df.join(_prefixed(lookup, prefix), F.expr(match), "left")


def attach_both_accounts(df: DataFrame, lookup: DataFrame, sides: dict[str, tuple[str, str]], line: str) -> DataFrame:
    """Adds {prefix}account_key and {prefix}status for each prefix and its number and bank, by one join for all.

    For account tables that are not broadcast. Each line gives a narrow row per side; these are joined with the
    accounts, put together by line, and joined back. So whole rows are shuffled once, not once per side.
    ``line`` names a column that is unique and the same whenever ``df`` is evaluated, such as the ids of a
    scan of files.
    """
    pairs = ", ".join(
        f"struct('{prefix}' AS _side, {number} AS _number, {case_key(bank)} AS _bank)" for prefix, (number, bank) in sides.items()
    )
    narrow = df.selectExpr(f"{line} AS _line", f"inline(array({pairs}))")
    match = (F.col("_number") == F.col("account_key")) & (F.col("_bank") == F.col("account_bank_key"))
    found = narrow.join(lookup.select("account_key", "account_bank_key", "status"), match)
    of_side = lambda prefix: F.max(F.when(F.col("_side") == prefix, F.struct("account_key", "status"))).alias(prefix)
    lines = found.groupBy("_line").agg(*[of_side(prefix) for prefix in sides])
    return df.join(lines, F.col(line) == F.col("_line"), "left").select(
        *df.columns, *[F.col(prefix)[field].alias(prefix + field) for prefix in sides for field in ("account_key", "status")]
    )


def rows_with_unknown_bank(df: DataFrame, banks: DataFrame, code: str) -> DataFrame:
    """Anti join: rows whose bank code is not in the table."""
    dim = bank_lookup(banks).select("bank_key")
    return df.join(dim, F.expr(f"{case_key(code)} = bank_key"), "left_anti")


def rows_with_known_account(df: DataFrame, accounts: DataFrame, number: str, bank: str) -> DataFrame:
    """Semi join: rows whose account is in the table, whatever its status."""
    dim = account_lookup(accounts).select("account_key", "account_bank_key")
    match = f"{number} = account_key AND {case_key(bank)} = account_bank_key"
    return df.join(dim, F.expr(match), "left_semi")


def limit_by_type(limits: DataFrame, transaction_type: str) -> DataFrame:
    """The limit of one type, compared without case; empty if there is none."""
    matching = limits.filter(f"{case_key('transactionType')} = {case_key(quoted(transaction_type))}")
    keyed = matching.withColumn("_key", F.expr(case_key("transactionType")))
    return first_wins(keyed, ["_key"], "ord").select("transactionType", "minAmount", "maxAmount", "currency")


def _prefixed(dim: DataFrame, prefix: str) -> DataFrame:
    return dim.selectExpr(*[f"{c} AS {prefix}{c}" for c in dim.columns])
