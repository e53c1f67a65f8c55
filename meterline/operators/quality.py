"""Data-quality checks. Every check yields failing rows or one report line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; NULL keys are left out."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent lacks; NULL keys pass."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[object], by: Sequence[str] = ()) -> DataFrame:
    """Values outside the accepted list with their row counts, per columns ``by``; NULL passes."""
    return df.filter(~F.col(column).isin(*accepted)).groupBy(*by, F.col(column).alias("value_field")).agg(
        F.count("*").alias("n_records")
    )


def freshness(df: DataFrame, loaded_at: str, as_of: datetime, warn_hours: float, error_hours: float) -> DataFrame:
    """Age of the newest row against two limits; an empty source is an error."""
    age = (F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp("max_loaded_at")) / 3600
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_hours", age)
        .withColumn(
            "status",
            F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
            .when(F.col("age_hours") > warn_hours, "warn")
            .otherwise("pass"),
        )
    )


@dataclass(frozen=True)
class RowCheck:
    """A check on single rows: ``failing`` is true where the row breaks it."""

    name: str
    failing: Column
    severity: str = "error"


@dataclass(frozen=True)
class KeyCheck:
    """Uniqueness of one column, over the rows ``among`` or all."""

    name: str
    key: str
    severity: str = "error"
    among: Column | None = None


def flag_orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str, flag: str) -> DataFrame:
    """Add a flag that is true on child rows whose key the parent lacks."""
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = df.join(known, F.col(key) == F.col("_parent"), "left")
    return joined.withColumn(flag, F.col(key).isNotNull() & F.col("_parent").isNull()).drop("_parent")


def report(df: DataFrame, row_checks: Sequence[RowCheck], key_checks: Sequence[KeyCheck] = ()) -> DataFrame:
    """One line per check: name, severity, failures and status.

    All row checks share one pass over the data; each uniqueness check adds one.
    """
    severity: Mapping[str, str] = {check.name: check.severity for check in [*row_checks, *key_checks]}
    lines = df.agg(*[F.count_if(check.failing).alias(check.name) for check in row_checks]).unpivot(
        [], [check.name for check in row_checks], "check_name", "failures"
    )
    for check in key_checks:
        rows = df if check.among is None else df.filter(check.among)
        failures = duplicate_keys(rows, check.key).agg(F.count("*").alias("failures"))
        lines = lines.unionByName(failures.select(F.lit(check.name).alias("check_name"), "failures"))
    level = F.lit("error")
    for name, value in severity.items():
        level = F.when(F.col("check_name") == name, value).otherwise(level)
    return lines.withColumn("severity", level).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    )


def stop_on_error(lines: DataFrame) -> DataFrame:
    """Raise when a check of severity ``error`` failed; warnings go on."""
    failed = [row.check_name for row in lines.filter("status = 'error'").select("check_name").collect()]
    if failed:
        raise ValueError(f"data-quality checks failed: {', '.join(sorted(failed))}")
    return lines
