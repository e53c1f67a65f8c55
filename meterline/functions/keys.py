"""Row identities built from column values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text, joined by ``-``, with a placeholder for NULL."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PLACEHOLDER)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def row_hash(*parts: Column) -> Column:
    """md5 over the parts as text without a separator, NULL as empty text.

    ``('1', '23')`` and ``('12', '3')`` collide; use ``surrogate_key`` for new keys.
    Doubles must be cast to decimal first, as their text form is engine-specific.
    """
    return F.md5(F.concat(*[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))


def row_hash_bytes(*parts: Column) -> Column:
    """The same hash as 16 bytes."""
    return F.unhex(row_hash(*parts))


def any_null(*parts: Column) -> Column:
    """True when at least one part is NULL."""
    return reduce(lambda left, right: left | right, [part.isNull() for part in parts])
