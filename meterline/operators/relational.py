"""Projections, filters and set operations that need more than one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both frames have, in the left frame's order; case is ignored."""
    shared = {name.lower() for name in right.columns}
    return [name for name in left.columns if name.lower() in shared]


def union_common(left: DataFrame, right: DataFrame, left_tag: str, right_tag: str, tag: str = "service_type") -> DataFrame:
    """All rows of both frames on their common columns, tagged by origin; types widen."""
    shared = common_columns(left, right)
    return (
        left.select(shared).withColumn(tag, F.lit(left_tag))
        .unionByName(right.select(shared).withColumn(tag, F.lit(right_tag)))
    )


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column some frames lack becomes NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def with_default_columns(df: DataFrame, columns: Sequence[str], default: str = "N/A") -> DataFrame:
    """The wanted columns as text, with a default where the value or the column is missing."""
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            F.coalesce(F.col(name).cast("string"), F.lit(default)).alias(name)
            if name.lower() in present
            else F.lit(default).alias(name)
            for name in columns
        ]
    )


def cast_present(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast those of the named columns the frame has; unreadable values become NULL.

    Evens out files of one source whose column types drift.
    """
    names = {name.lower(): name for name in df.columns}
    found = {names[name.lower()]: dtype for name, dtype in types.items() if name.lower() in names}
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in found.items()})


def add_column(df: DataFrame, name: str, type_name: str, default: object = None) -> DataFrame:
    """A new column with the same value on every row."""
    return df.withColumn(name, F.lit(default).cast(type_name))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows a DELETE would leave: those where the condition is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def on_dates(df: DataFrame, ts: str, first: date, end: date) -> DataFrame:
    """Rows from the first day up to, but without, the end day.

    Compared as timestamps, so that the range reaches the Parquet statistics.
    """
    return df.filter(
        (F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp"))
    )


def last_days(df: DataFrame, ts: str, as_of: date, days: int = 30) -> DataFrame:
    """Rows from ``days`` days before ``as_of`` on."""
    return df.filter(F.col(ts) >= F.date_sub(F.lit(as_of), days).cast("timestamp"))


def not_in(probe: DataFrame, key: str, values: DataFrame, value: str) -> DataFrame:
    """``key NOT IN (SELECT value ...)`` with SQL's NULL rules, at any list size.

    A NULL in the list leaves no rows, and NULL keys never qualify unless the
    list is empty. The list is counted once and joined as an ordinary anti join,
    so neither side has to fit in memory.
    """
    listed = values.agg(
        F.count("*").alias("all"), F.count(value).alias("known")
    )
    has_null = listed.select((F.col("all") > F.col("known")).alias("v")).scalar()
    is_empty = listed.select((F.col("all") == 0).alias("v")).scalar()
    keyed = values.select(F.col(value).alias("_listed"))
    return probe.filter(is_empty | (F.col(key).isNotNull() & ~has_null)).join(
        keyed, F.col(key) == F.col("_listed"), "left_anti"
    )


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order; only ``n`` rows per task leave the tasks."""
    return df.orderBy(*order).limit(n)


def at_maximum(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the column's overall maximum."""
    top = df.agg(F.max(column).alias("_top")).scalar()
    return df.filter(F.col(column) == top)
