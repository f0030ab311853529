"""Raw text to typed transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import TRANSACTION_FIELDS
from ..functions.amounts import with_amount
from ..functions.text import clean_text, has_control_character


def cleanse(raw: DataFrame) -> DataFrame:
    """Trims all fields, gives a missing note its default and parses the amount.

    Adds ``amount_text`` and ``amount_rest`` (see ``functions.amounts``) and the
    starting state of the check, ``valid`` and ``validationErrors``. Other columns
    of ``raw`` are kept.
    """
    others = [c for c in raw.columns if c not in TRANSACTION_FIELDS]
    # Trimming spaces only is several times faster, and right for rows without other blanks.
    checked = raw.withColumn("_controls", F.expr(has_control_character(*TRANSACTION_FIELDS)))
    trimmed = checked.selectExpr(
        *others,
        *[
            f"IF(_controls, {clean_text(c)}, trim(coalesce({c}, ''))) AS {'_written' if c == 'amount' else c}"
            for c in TRANSACTION_FIELDS
        ],
    )
    return with_amount(trimmed, "_written", "amount", "amount_text", "amount_rest").selectExpr(
        *others,
        *TRANSACTION_FIELDS,
        "amount_text",
        "amount_rest",
        "TRUE AS valid",
        "CAST(NULL AS STRING) AS validationErrors",
    )
