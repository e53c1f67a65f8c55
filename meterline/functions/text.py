"""Labels and text forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zone_label(borough: Column, zone: Column) -> Column:
    """``Borough/Zone``, NULL when either is missing."""
    return F.concat(borough, F.lit("/"), zone)


def year_quarter(ts: Column) -> Column:
    """``2020/Q1``."""
    return F.concat(F.year(ts).cast("string"), F.lit("/Q"), F.quarter(ts).cast("string"))


def digits_only(value: Column) -> Column:
    """The value without anything that is not a digit."""
    return F.regexp_replace(value, "[^0-9]", "")


def zero_padded(text: Column, width: int) -> Column:
    """Left-pad with zeros; longer text stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def base_id(base_number: Column) -> Column:
    """Short id of a dispatching base: ``B02884`` gives ``s/b44``.

    The letter is ``s`` for numbers divisible by 7, else ``a`` when divisible
    by 3, else ``e``; the number follows in hex with at least three digits. A number
    beyond 64 bits has no id.
    """
    number = F.substr(base_number, F.lit(2)).try_cast("bigint")
    letter = F.when(number % 7 == 0, "s").when(number % 3 == 0, "a").otherwise("e")
    return F.concat(letter, F.lit("/"), zero_padded(F.lower(F.hex(number)), 3))
