"""Generated transactions: a projection over a frame of ids.

Every choice is arithmetic on the id, so a row depends on nothing but its id and
the seed: the work is spread over the partitions of the id frame, a lost task
yields the same rows again, and other engines can repeat the formulas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import (
    ACCOUNTS, BANK_CODES, DEFAULT_INVALID_RATE, FAULT_WEIGHTS, GENERATOR_CURRENCY, NOTES,
    TRANSACTION_LIMITS, UNKNOWN_BANK_CODES, UNKNOWN_NAME, UNKNOWN_NUMBER_RANGE,
)
from ..functions.text import quoted

# Large factors would overflow for large ids, so these are folded first.
_FOLD = 1_000_003


def generate_transactions(
    ids: DataFrame, invalid_rate: float = DEFAULT_INVALID_RATE, seed: int = 0
) -> DataFrame:
    """One raw transaction per row of ``ids`` (column ``id``, not negative), plus ``fault``.

    ``invalid_rate`` is the share of faulty rows, clamped to 0..1. ``fault`` names
    the fault put in, or is null.
    """
    rate = max(0.0, min(1.0, invalid_rate))
    low, high = UNKNOWN_NUMBER_RANGE
    # Intermediate values are columns, so that each is computed once and the generated code stays short.
    folded = ids.selectExpr("*", f"id + {int(seed)}L AS k").selectExpr(
        "*", f"k % {_FOLD} AS folded", "k * 31 % 12 AS first_active", f"k % {len(TRANSACTION_LIMITS)} AS type"
    )
    drawn = folded.selectExpr("*", f"{_draw(742938285)} % 100 AS percent").selectExpr(
        "*",
        f"IF({_draw(1103515245)} % 1000 >= {round(1000 * (1 - rate))}, {_fault()}, NULL) AS fault",
        "k div 7 % 2 = 0 AS at_source",
        f"{_pick([limit[1] + 'L' for limit in TRANSACTION_LIMITS], 'type')} AS low",
        f"{_pick([limit[2] + 'L' for limit in TRANSACTION_LIMITS], 'type')} AS high",
        f"{low} + folded * 982451 % {high - low + 1} AS unknown",
    )
    sides = drawn.selectExpr(
        "*",
        f"{_account('first_active', 'at_source')} AS source",
        f"{_account('(first_active + 1 + k * 17 % 11) % 12', 'NOT at_source')} AS beneficiary",
    )
    amount = """IF(fault = 'below_minimum', 1 + folded * 15485863 % (low - 1),
                   low + folded * 1299709 % (high - low + 1))"""
    return sides.selectExpr(
        *ids.columns,
        "format_string('TRX-%07d', id) AS referenceId",
        *_party("source", "at_source"),
        *_party("beneficiary", "NOT at_source"),
        f"'{GENERATOR_CURRENCY}' AS currency",
        f"CAST({amount} AS STRING) AS amount",
        f"{_pick_text([limit[0] for limit in TRANSACTION_LIMITS], 'type')} AS transactionType",
        f"{_pick_text(NOTES, f'k div 13 % {len(NOTES)}')} AS note",
        "fault",
    )


def generate_range(spark: SparkSession, rows: int, **kwargs) -> DataFrame:
    """``rows`` transactions with ids from 1."""
    return generate_transactions(spark.range(1, rows + 1), **kwargs)


def _draw(factor: int) -> str:
    """A multiplicative congruential draw: independent for different factors, below 2^31 - 1."""
    return f"(folded + 1) * {factor} % 2147483647"


def _fault() -> str:
    """The fault whose cumulative share covers the drawn percent (0..99)."""
    cases, limit = [], 0
    for name, weight in FAULT_WEIGHTS:
        limit += weight
        cases.append(f"WHEN percent < {limit} THEN '{name}'")
    return f"CASE {' '.join(cases)} END"


def _account(active: str, faulty: str) -> str:
    """A side's account (number, name, bank) from the seeded list, or null for an unknown one.

    ``active`` counts within the active accounts only.
    """
    places = lambda status: [str(i) for i, account in enumerate(ACCOUNTS) if account[3] == status]
    inactive, blocked = places("INACTIVE"), places("BLOCKED")
    place = f"""CASE
        WHEN {faulty} AND fault = 'inactive' THEN {_pick(inactive, f'k div 5 % {len(inactive)}')}
        WHEN {faulty} AND fault = 'blocked' THEN {_pick(blocked, f'k % {len(blocked)}')}
        WHEN NOT ({faulty} AND fault <=> 'unknown') THEN {_pick(places('ACTIVE'), active)} END"""
    rows = [
        f"named_struct('number', {quoted(number)}, 'name', {quoted(name)}, 'bank', {quoted(bank)})"
        for number, name, bank, _ in ACCOUNTS
    ]
    return _pick(rows, place)


def _party(role: str, faulty: str) -> list[str]:
    """Account, name and bank of one side, the bank with the row's fault applied."""
    seeded = ", ".join(f"'{account[0]}'" for account in ACCOUNTS)
    # No two seeded numbers are neighbours, so the next number is free.
    number = f"CAST(unknown + IF(CAST(unknown AS STRING) IN ({seeded}), 1, 0) AS STRING)"
    some_bank = _pick_text([bank[0] for bank in BANK_CODES], f"k div 11 % {len(BANK_CODES)}")
    no_bank = _pick_text(UNKNOWN_BANK_CODES, f"k div 3 % {len(UNKNOWN_BANK_CODES)}")
    return [
        f"coalesce({role}.number, {number}) AS {role}Account",
        f"coalesce({role}.name, {quoted(UNKNOWN_NAME)}) AS {role}AccountName",
        f"IF({faulty} AND fault = 'bank_code', {no_bank}, coalesce({role}.bank, {some_bank})) AS {role}BankCode",
    ]


def _pick(values, index: str) -> str:
    """SQL: element of a fixed list by a 0-based index."""
    return f"get(array({', '.join(values)}), CAST({index} AS INT))"


def _pick_text(values, index: str) -> str:
    return _pick([quoted(v) for v in values], index)
