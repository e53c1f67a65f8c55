"""Writing tables: file counts, partitions and clustering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.workspace import new_dir

# Tasks per wanted file that rows are dealt to before each file is written by one.
PIECES = 16


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write Parquet; modes are error, overwrite, append and ignore."""
    df.write.mode(mode).parquet(path)


def write_in_files(df: DataFrame, path: str, files: int, mode: str = "error") -> None:
    """Write exactly ``files`` files of even size.

    A file is one task's work however many rows there are. They are dealt to ``PIECES`` times as many
    tasks and stored, so that this task reads compressed columns in place of shuffled rows.
    """
    spark, pieces, number = df.sparkSession, new_dir(df.sparkSession, "pieces"), "_file"
    while number in df.columns:
        number = f"_{number}"
    dealt = df.repartition(files * PIECES).withColumn(number, F.spark_partition_id() % files)
    dealt.write.option("compression", "zstd").partitionBy(number).parquet(pieces)
    stored = spark.read.schema(dealt.schema).parquet(pieces)
    parts = [stored.filter(F.col(number) == k).drop(number).coalesce(1) for k in range(files)]
    # One task for each part: a union of single partitions would else be a single partition itself.
    setting = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        reduce(DataFrame.union, parts).write.mode(mode).parquet(path)
    finally:
        spark.conf.set(setting, before)


def write_single_file(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a small report as one file.

    The extra shuffle keeps the report's own stages parallel: a coalesce to one
    would pull its last aggregation into a single task.
    """
    report.repartition(1).write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], mode: str = "error", sort_by: Sequence[str] = (),
    gathered: bool = False, codec: str | None = None,
) -> None:
    """Write folders by column values, with files of even size.

    Rebalancing gathers a partition's rows and splits a hot one over several
    tasks. In overwrite mode only the partitions present in ``df`` are replaced.
    ``sort_by`` orders the rows of every file, so that readers skip row groups.
    Rows that come ``gathered``, as from files of one value each, are written where they are read.
    """
    balanced = df if gathered else df.hint("rebalance", *[F.col(name) for name in columns])
    if sort_by:
        balanced = balanced.sortWithinPartitions(*columns, *sort_by)
    writer = balanced.write.option("compression", codec) if codec else balanced.write
    writer.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def write_by_date(df: DataFrame, path: str, ts: str, date_column: str, mode: str = "error", cluster_by: Sequence[str] = ()) -> None:
    """Partition by the date of a timestamp, optionally clustered within each date."""
    dated = df.withColumn(date_column, F.to_date(ts))
    write_partitioned(dated, path, [date_column], mode, cluster_by)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, columns: Sequence[str]) -> None:
    """Save as a table of ``path`` in ``buckets`` buckets by ``columns``, sorted within them.

    Tables with the same buckets join and group by these columns without a shuffle. Rows are dealt to
    the buckets first, so a bucket is one file.
    """
    dealt = df.repartition(buckets, *[F.col(name) for name in columns])
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """A number that is near for rows whose columns are all near: the columns' ranks with their bits in turn.

    Ranks are places among ``2 ** bits`` borders of approximately equal shares, of which
    one small row reaches the driver. Nulls come first.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    number = {name: F.col(name).cast("double") for name in columns}
    borders = df.agg(*[F.percentile_approx(number[name], shares, 10 * 2**bits).alias(name) for name in columns]).first()
    result = F.lit(0).cast("long")
    for place, name in enumerate(columns):
        cuts = sorted(set(borders[name] or []))
        rank = F.when(number[name].isNull(), 0).otherwise(_place(number[name], cuts))
        for bit in range(bits):
            result = result.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("long"), bit * len(columns) + place))
    return result


def _place(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending ``cuts`` are at or below the value, by halving."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    return F.when(value < cuts[middle], _place(value, cuts[:middle])).otherwise(F.lit(middle + 1) + _place(value, cuts[middle + 1:]))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 8, mode: str = "error") -> None:
    """Write files that each hold a narrow range of every one of ``columns``, so that filters on any of them skip files."""
    order = "_order"
    placed = df.withColumn(order, interleaved(df, columns, bits))
    placed.repartitionByRange(files, order, *columns).sortWithinPartitions(order, *columns).drop(order).write.mode(mode).parquet(path)


def partition_row_counts(table: DataFrame, partition_column: str) -> DataFrame:
    """Rows per partition, the largest first."""
    return (
        table.groupBy(F.col(partition_column).alias("partition_id")).agg(F.count("*").alias("total_rows"))
        .orderBy(F.col("total_rows").desc(), "partition_id")
    )


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Number and mean size of the Parquet files under a folder, without reading them."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(path)
    )
    return listed.agg(
        F.count("*").alias("files"), (F.avg("length") / (1024 * 1024)).alias("avg_megabytes")
    )
