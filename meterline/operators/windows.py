"""Row choice within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, by default all other columns ascending.

    The default is a total order up to identical rows, so reruns keep the same
    row. Spark limits every group to one row before the shuffle as well, which
    keeps a hot key cheap.
    """
    if order is None:
        order = [F.col(name).asc_nulls_first() for name in df.columns if name not in keys]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def at_dense_rank(df: DataFrame, keys: Sequence[str], order: Column, rank: int) -> DataFrame:
    """All rows whose dense rank within the key equals ``rank``."""
    ranked = df.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.filter(F.col("_rank") == rank).drop("_rank")
