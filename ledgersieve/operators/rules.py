"""Rules: a named condition and a message each, evaluated together in list order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import ERROR_SEPARATOR
from ..functions.text import quoted


@dataclass(frozen=True)
class Rule:
    """A row fails the rule where ``condition`` is true; a null condition counts as passed.

    Condition and message are SQL expressions over the columns of the frame.
    """

    name: str
    condition: str
    message: str


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Sets ``valid`` and ``validationErrors``.

    All rules are evaluated, whatever the others say. The messages of those that
    fail are joined in list order; a valid row has none (null). ``valid`` does not
    depend on the messages, so these are not built where only it is used.
    """
    failed = " OR ".join(_fails(rule) for rule in rules) or "FALSE"
    messages = [f"IF({_fails(rule)}, {rule.message}, NULL)" for rule in rules]
    joined = f"concat_ws({', '.join([quoted(ERROR_SEPARATOR), *messages])})"
    return df.withColumns({"valid": F.expr(f"NOT ({failed})"), "validationErrors": F.expr(f"nullif({joined}, '')")})


def count_rule_hits(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows failing each rule (rule, hits), in one pass."""
    counts = df.agg(*[F.expr(f"count_if({_fails(rule)})").alias(rule.name) for rule in rules])
    lines = ", ".join(f"named_struct('rule', {quoted(rule.name)}, 'hits', {rule.name})" for rule in rules)
    return counts.select(F.expr(f"inline(array({lines}))"))


def _fails(rule: Rule) -> str:
    return f"coalesce({rule.condition}, FALSE)"
