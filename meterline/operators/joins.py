"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns both sides share, where NULL keys match each other."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])
