"""Casts with warehouse semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meterline.schemas import NUMERIC


# A failed try_cast costs an exception per row, so text is checked first.
_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def safe_int(value: Column, is_text: bool = True) -> Column:
    """NULL when the value is not an integer; ``'1.0'`` is not one."""
    return F.when(value.rlike(_INTEGER), value.try_cast("int")) if is_text else value.try_cast("int")


def int_via_double(value: Column, is_text: bool = True) -> Column:
    """Integer from float-looking text: ``'1.0'`` gives 1, halves round away from zero."""
    number = F.when(value.rlike(_NUMBER), value.try_cast("double")) if is_text else value.cast("double")
    return F.round(number).try_cast("int")


def numeric(value: Column) -> Column:
    """Exact decimal for money and distances."""
    return value.cast(NUMERIC)
