"""Code tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meterline.functions.casts import int_via_double

# Payment codes and their labels.
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT = "EMPTY"


def payment_type_description(code: Column, is_text: bool = True) -> Column:
    """Label of a payment code; every other value, NULL included, reads ``EMPTY``."""
    number = int_via_double(code, is_text)
    label = F.lit(None).cast("string")
    for known, text in PAYMENT_TYPES.items():
        label = F.when(number == known, text).otherwise(label)
    return F.coalesce(label, F.lit(OTHER_PAYMENT))
