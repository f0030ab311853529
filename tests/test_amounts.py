"""Amount parsing against Python decimals, which print numbers the same way."""

import re
from decimal import ROUND_DOWN, Context, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from ledgersieve.functions.amounts import with_amount

NUMBER = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\Z", re.ASCII)
EXACT = Context(prec=500, Emax=10**12, Emin=-(10**12))

FIXED = [
    "5000", "5000.50", "+5", "007500.50", ".5", "5.", "1e5", "1E-9", "-0", "-0.00", "0E+3", "0e3", "0.0000001",
    "0.000000", "0.0000000", "abc", "", "1_000", "1 0", "9999.99999", "9999.9999999999999999999", "1" + "0" * 30,
    "-1" + "0" * 30, "1e999999999", "1e-999999999", "1e99999999999", "0e999999", "-1e-19", ".", "e5", "1e", "--1",
    "0x10", "1.2.3", "5d", "NaN", "Infinity", "12345678901234567890.123456789", "123456789012345678901",
    "00000000000000000000000000012",
]


def expected(text):
    if not NUMBER.match(text):
        return "0", Decimal(0), 0
    value = EXACT.create_decimal(text)
    if abs(value.as_tuple().exponent) > 2**31 - 1:
        return "0", Decimal(0), 0
    if value == 0:
        return EXACT.to_sci_string(value.copy_abs()), Decimal(0), 0
    printed = EXACT.to_sci_string(value)
    sign = -1 if value < 0 else 1
    if value.adjusted() >= 20:
        return printed, None, sign  # too large for the decimal column
    if value.adjusted() < -300:
        return printed, Decimal(0), sign
    cut = value.quantize(Decimal("1e-18"), rounding=ROUND_DOWN, context=EXACT)
    return printed, cut, 0 if cut == value else sign


def parse(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = with_amount(frame, "t", "amount", "amount_text", "amount_rest").orderBy("i").collect()
    return [(r.amount_text, r.amount, r.amount_rest) for r in rows]


def test_known_forms(spark):
    assert parse(spark, FIXED) == [expected(t) for t in FIXED]


digits = st.text("0123456789", max_size=25)
number_like = st.builds(
    lambda sign, whole, point, fraction, exponent: sign + whole + point + fraction + exponent,
    st.sampled_from(["", "", "-", "+"]), digits, st.sampled_from(["", "."]), digits,
    st.sampled_from(["", "", "", "e5", "E-7", "e-30", "E+30", "e0"]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(number_like, min_size=150, max_size=150))
def test_any_number(spark, texts):
    assert parse(spark, texts) == [expected(t) for t in texts]
