"""Exact interpolated percentiles that never hold a large group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from meterline.operators.joins import join_null_safe
from meterline.workspace import materialize

SLICES = 256


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]) -> DataFrame:
    """One row per group with the named percentiles of ``value``; NULLs are skipped.

    Equal values are counted before the shuffle, so repeats cost nothing. Every group
    is cut into value slices, and only the slices that hold a wanted rank are sorted.
    """
    if not keys:
        return exact_percentiles(df.withColumn("_all", F.lit(1)), ["_all"], value, probabilities).drop("_all")
    keys = list(keys)
    counted = materialize(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n")),
        "value-counts",
    )
    # Slice borders only balance the work; any borders give the same result. They are
    # stored, since every later step must see the same ones; slices follow from them.
    approximate = F.percentile_approx("_value", [i / SLICES for i in range(1, SLICES)], SLICES * 10)
    borders = materialize(counted.groupBy(*keys).agg(approximate.alias("_borders")), "value-borders")
    sliced = (
        join_null_safe(counted, borders, keys)
        .withColumn("_slice", F.size(F.filter("_borders", lambda border: border < F.col("_value"))))
        .drop("_borders")
    )
    # At most SLICES rows per group from here on.
    sizes = sliced.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_size"))
    in_group = Window.partitionBy(*keys)
    placed = sizes.withColumn(
        "_before",
        F.sum("_size").over(in_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"),
    ).withColumn("_total", F.sum("_size").over(in_group))
    wanted = placed.withColumn(
        "_want",
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("name"), ((F.col("_total") - 1) * F.lit(float(p))).alias("position"))
                for name, p in probabilities.items()
            ])
        ),
    )
    low, high = F.floor("_want.position"), F.ceil("_want.position")
    end = F.col("_before") + F.col("_size")
    wanted = wanted.filter((low < end) & (high >= F.col("_before"))).select(
        *keys, "_slice", "_before", F.col("_want.name").alias("_name"),
        F.col("_want.position").alias("_position"),
    )
    needed = join_null_safe(
        sliced, wanted.select(*keys, "_slice").distinct(), [*keys, "_slice"], "left_semi"
    )
    running = needed.withColumn(
        "_upto",
        F.sum("_n").over(
            Window.partitionBy(*keys, "_slice").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    first = F.col("_before") + F.col("_upto") - F.col("_n")
    last = F.col("_before") + F.col("_upto") - 1
    low, high = F.floor("_position"), F.ceil("_position")
    hits = join_null_safe(running, wanted, [*keys, "_slice"]).filter((low <= last) & (high >= first))
    ends = hits.groupBy(*keys, "_name", "_position").agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    # Same arithmetic as the built-in: weigh both neighbours by their distance.
    point = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        (F.ceil("_position") - F.col("_position")) * F.col("_low")
        + (F.col("_position") - F.floor("_position")) * F.col("_high")
    )
    return ends.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, point)).alias(name) for name in probabilities]
    )
