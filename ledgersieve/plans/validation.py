"""The transaction check: five lookups, then one projection with all rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import (
    AMOUNT_ERROR, BENEFICIARY_ACCOUNT_ERROR, BENEFICIARY_BANK_ERROR, NO_RESULT_ERROR, SOURCE_ACCOUNT_ERROR,
    SOURCE_BANK_ERROR, STATUS_NOT_FOUND,
)
from ..functions.text import fill, quoted
from ..operators.cleanse import cleanse
from ..operators.lookups import attach_account, attach_bank, attach_both_accounts, attach_limit
from ..operators.rules import Rule, apply_rules
from ..operators.validators import amount_reason, is_active
from ..schemas import CORRUPT_COLUMN, RESULTS
from ..sources.dimensions import (
    account_lookup, bank_lookup, limit_lookup, seeded_accounts, seeded_banks, seeded_limits,
)
from ..sources.transactions import rescue_short_lines


# Raw text columns in, cleansed rows as ``cleanse`` gives them out.
Mapper = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class References:
    """The three tables a transaction is checked against.

    ``accounts_by_line`` is for an account table too large to be broadcast: both accounts of a line are then looked
    up by one join of narrow rows. The transactions must come from files or tables, whose rows get the same
    numbers whenever they are read.
    """

    banks: DataFrame
    limits: DataFrame
    accounts: DataFrame
    accounts_by_line: bool = False

    @staticmethod
    def seeded(spark: SparkSession) -> "References":
        return References(seeded_banks(spark), seeded_limits(spark), seeded_accounts(spark))


def transaction_rules() -> list[Rule]:
    """The rules over the columns of ``look_up``, in the order of their messages."""

    def account_rule(name: str, account: str, status: str, message: str) -> Rule:
        return Rule(name, f"NOT no_account_result AND NOT {is_active(status)}", fill(message, account, status))

    return [
        Rule("source_bank", "NOT source_bank_known", fill(SOURCE_BANK_ERROR, "sourceBankCode")),
        Rule("beneficiary_bank", "NOT beneficiary_bank_known", fill(BENEFICIARY_BANK_ERROR, "beneficiaryBankCode")),
        # One text for every amount failure; the real reason is in amount_reason.
        Rule("amount", "amount_reason IS NOT NULL", fill(AMOUNT_ERROR, "amount_text", "transactionType")),
        Rule("account_lookup", "no_account_result", quoted(NO_RESULT_ERROR)),
        account_rule("source_account", "sourceAccount", "source_status", SOURCE_ACCOUNT_ERROR),
        account_rule("beneficiary_account", "beneficiaryAccount", "beneficiary_status", BENEFICIARY_ACCOUNT_ERROR),
    ]


def look_up(clean: DataFrame, references: References) -> DataFrame:
    """Cleansed rows (no nulls, all trimmed) plus what the rules need to know.

    The accounts come first: if that table is too large to broadcast, the rows are
    shuffled before the small lookups have widened them.
    """
    accounts, banks = account_lookup(references.accounts), bank_lookup(references.banks)
    sides = {"_src_": ("sourceAccount", "sourceBankCode"), "_bene_": ("beneficiaryAccount", "beneficiaryBankCode")}
    if references.accounts_by_line:
        numbered = clean.withColumn("_number_of_line", F.monotonically_increasing_id())
        df = attach_both_accounts(numbered, accounts, sides, "_number_of_line")
    else:
        df = clean
        for prefix, (number, bank) in sides.items():
            df = attach_account(df, accounts, number, bank, prefix)
    df = attach_bank(df, banks, "sourceBankCode", "_src_bank_")
    df = attach_bank(df, banks, "beneficiaryBankCode", "_bene_bank_")
    df = attach_limit(df, limit_lookup(references.limits), "transactionType", "_limit_")

    def status(side: str) -> str:
        return f"IF(_{side}_account_key IS NOT NULL, upper(_{side}_status), '{STATUS_NOT_FOUND}')"

    return df.selectExpr(
        *clean.columns,
        "_src_bank_bank_key IS NOT NULL AS source_bank_known",
        "_bene_bank_bank_key IS NOT NULL AS beneficiary_bank_known",
        f"{amount_reason('transactionType', 'amount', 'amount_text', 'amount_rest', '_limit_')} AS amount_reason",
        # A pair with a blank field is refused as a whole, so neither account gets a result.
        "'' IN (sourceAccount, sourceBankCode, beneficiaryAccount, beneficiaryBankCode) AS no_account_result",
        f"{status('src')} AS source_status",
        # Results are known by account number alone and the first one counts, so a
        # transfer to the same number takes the source's result for both sides.
        f"IF(sourceAccount = beneficiaryAccount, {status('src')}, {status('bene')}) AS beneficiary_status",
    )


def validate_transactions(
    clean: DataFrame, references: References, rules: list[Rule] | None = None
) -> DataFrame:
    """Cleansed rows with ``valid``, ``validationErrors`` and ``amount_reason`` set.

    Every input row gives exactly one output row. ``rules`` replaces the standard
    list; its conditions may use all columns of ``look_up``.
    """
    checked = apply_rules(look_up(clean, references), transaction_rules() if rules is None else rules)
    return checked.select(*clean.columns, "amount_reason")


def check_lines(
    scanned: DataFrame, references: References, rules: list[Rule] | None = None, mapper: Mapper = cleanse
) -> DataFrame:
    """Scanned lines (with ``line_id``) to result rows: the fields, the errors and the outcome.

    ``rules`` and ``mapper`` replace the standard rules and the standard ``cleanse``.

    The outcome is valid, invalid, or quarantined for a line with a wrong number of
    fields. No line is left out, so line ids stay gapless within a task. The amount
    is shown as printed.
    """
    checked = validate_transactions(rescue_short_lines(scanned).transform(mapper), references, rules)
    good = f"{CORRUPT_COLUMN} IS NULL"
    changed = {
        "amount": "amount_text",
        "validationErrors": f"IF({good}, validationErrors, NULL)",
        "amount_reason": f"IF({good}, amount_reason, NULL)",
        "outcome": f"CASE WHEN NOT ({good}) THEN 'quarantined' WHEN valid THEN 'valid' ELSE 'invalid' END",
    }
    return checked.selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in RESULTS.fieldNames()])
