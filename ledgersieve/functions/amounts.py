"""Amounts: lenient parsing, exact comparison and the printed form.

An amount is arbitrary-precision text. Three columns stand for it:

* ``amount``       decimal(38,18), cut to 18 decimals; null if it has over 20 digits before the
                   point, 0 if the text is no number
* ``amount_text``  the number as printed: the written scale is kept, an exponent is
                   used only for a negative scale or a leading digit beyond 1e-6
* ``amount_rest``  sign of what ``amount`` leaves out of the real value (of all of it if
                   ``amount`` is null), 0 if exact

With the rest the range tests are exact for any text, since limits have at most
18 decimals: a value cut to the maximum with a positive rest lies above it, and one too
large for the decimal lies on the side of its sign.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import AMOUNT_TYPE

# Text that is its own printed form and fits the decimal: the usual case.
_CANONICAL = r"\\A(0|[1-9][0-9]{0,19})([.][0-9]{1,6})?\\z"
# sign, digits, decimals | decimals only, exponent
_NUMBER = r"\\A([+-]?)(?:([0-9]+)(?:[.]([0-9]*))?|[.]([0-9]+))(?:[eE]([+-]?[0-9]+))?\\z"
_MAX_SCALE = 2**31 - 1


def with_amount(df: DataFrame, source: str, amount: str, text: str, rest: str) -> DataFrame:
    """Adds the three amount columns for the trimmed text in ``source``."""
    parsed = f"""
        CASE WHEN {source} RLIKE '{_CANONICAL}' THEN {_struct(f"try_cast({source} AS {AMOUNT_TYPE})", source, "0")}
             WHEN {source} RLIKE '{_NUMBER}' THEN {_general(source)}
             ELSE {_ZERO} END"""
    split = {name: F.col(f"_amount.{field}") for name, field in ((amount, "value"), (text, "text"), (rest, "rest"))}
    return df.withColumn("_amount", F.expr(parsed)).withColumns(split).drop("_amount")


def below(amount: str, rest: str, minimum: str) -> str:
    """SQL text: the real amount is less than the minimum."""
    return f"(coalesce({amount} < {minimum}, {rest} < 0) OR ({rest} < 0 AND {amount} = {minimum}))"


def above(amount: str, rest: str, maximum: str) -> str:
    """SQL text: the real amount is greater than the maximum."""
    return f"(coalesce({amount} > {maximum}, {rest} > 0) OR ({rest} > 0 AND {amount} = {maximum}))"


def _struct(value: str, text: str, rest: str) -> str:
    return f"named_struct('value', {value}, 'text', {text}, 'rest', {rest})"


_ZERO = _struct(f"CAST('0' AS {AMOUNT_TYPE})", "'0'", "0")


def _let(name: str, value: str, body: str) -> str:
    """The body with a name for an intermediate value, so that it is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _general(raw: str) -> str:
    """Signs, surplus zeros, exponents, bare points and any number of digits.

    Rare, so it is kept out of the generated code of the usual case, which would
    otherwise become too long to be compiled to machine code.
    """
    group = lambda i: f"regexp_extract({raw}, '{_NUMBER}', {i})"
    parts = f"""named_struct(
        'minus', {group(1)} = '-',
        'digits', regexp_replace(concat({group(2)}, {group(3)}, {group(4)}), '\\\\A0+(?=[0-9])', ''),
        'scale', length(concat({group(3)}, {group(4)}))
                 - CASE WHEN {group(5)} = '' THEN 0 ELSE try_cast({group(5)} AS BIGINT) END)"""
    # kept: how many leading digits lie within 18 decimals
    sized = """named_struct(
        'sign', IF(p.minus AND p.digits <> '0', '-', ''), 'digits', p.digits, 'scale', p.scale,
        'size', length(p.digits), 'exponent', length(p.digits) - 1 - p.scale,
        'kept', try_cast(greatest(length(p.digits) - greatest(p.scale - 18, 0), 0) AS INT))"""
    # The size test also keeps a huge exponent away from the cast, which would fail the task.
    cut = f"""CASE
        WHEN n.digits = '0' THEN CAST('0' AS {AMOUNT_TYPE})
        WHEN n.size - n.scale <= 20 THEN try_cast(
            concat(n.sign, IF(n.kept = 0, '0', left(n.digits, n.kept)), 'E', -least(n.scale, 18)) AS {AMOUNT_TYPE})
        END"""
    lost = "right(n.digits, n.size - n.kept) RLIKE '[1-9]'"
    small = "try_cast(n.scale AS INT)"
    printed = f"""CASE
        WHEN n.scale = 0 THEN n.digits
        WHEN n.scale > 0 AND n.exponent >= -6 AND n.size > n.scale
            THEN concat(left(n.digits, n.size - {small}), '.', right(n.digits, {small}))
        WHEN n.scale > 0 AND n.exponent >= -6 THEN concat('0.', lpad(n.digits, {small}, '0'))
        ELSE concat(left(n.digits, 1), IF(n.size = 1, '', concat('.', substring(n.digits, 2))),
                    'E', IF(n.exponent > 0, '+', ''), n.exponent) END"""
    number = _let("c", cut, _struct(
        "c",
        f"concat(n.sign, {printed})",
        f"CASE WHEN c IS NULL OR {lost} THEN IF(n.sign = '-', -1, 1) ELSE 0 END",
    ))
    return _let("p", parts, _let("n", sized, f"IF(abs(n.scale) <= {_MAX_SCALE}, {number}, {_ZERO})"))
