"""Distinct counts that can be merged: one stored sketch per group, any range of groups answered from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The standard error of a sketch is 1.04 over the root of its slots, of which there are 2 to this power.
SLOTS_LOG = 12


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, slots_log: int = SLOTS_LOG) -> DataFrame:
    """One sketch of the values of ``column`` per group; nulls are not values."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(slots_log)).alias("sketch"))


def merged_estimate(sketches: DataFrame, by: Sequence[str] = (), name: str = "estimate") -> DataFrame:
    """Estimated distinct values over all groups that ``by`` brings together; reads sketches only."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.hll_sketch_estimate("sketch").alias(name))


def standard_error(slots_log: int = SLOTS_LOG) -> float:
    return 1.04 / 2 ** (slots_log / 2)


def within_error(estimate: Column, exact: Column, slots_log: int = SLOTS_LOG, errors: float = 3) -> Column:
    """Whether an estimate is within some standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.greatest(errors * standard_error(slots_log) * exact, F.lit(0.5))
