"""What Parquet files say about themselves: counts and column ranges from footers, without reading rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMN_SCHEMA = (
    "file string, file_bytes long, row_groups int, n_rows long, column_name string, stored_bytes long, null_count long, low string, high string")


def pushed_down(spark: SparkSession) -> SparkSession:
    """A sibling session whose Parquet reader answers counts, minima and maxima from footers."""
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sources = [name for name in sibling.conf.get("spark.sql.sources.useV1SourceList").split(",") if name.strip() != "parquet"]
    sibling.conf.set("spark.sql.sources.useV1SourceList", ",".join(sources))
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return sibling


def partition_counts(spark: SparkSession, path: str, partition_column: str) -> DataFrame:
    """Rows per partition of a stored table, the largest first; only footers are read."""
    stored = pushed_down(spark).read.parquet(path)
    return (
        stored.groupBy(F.col(partition_column).alias("partition_id")).agg(F.count("*").alias("total_rows"))
        .orderBy(F.col("total_rows").desc(), "partition_id")
    )


def column_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a stored table, with the least and greatest value of some columns, from footers."""
    parts = [part for name in columns for part in (F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}"))]
    return pushed_down(spark).read.parquet(path).agg(F.count("*").alias("n_rows"), *parts)


def _text(value) -> str | None:
    return None if value is None else value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            files, place = fs.FileSystem.from_uri(path)
            with files.open_input_file(place) as file:
                footer = pq.ParquetFile(file).metadata
            columns: dict[str, list] = {}
            for group in range(footer.num_row_groups):
                for number in range(footer.num_columns):
                    column = footer.row_group(group).column(number)
                    columns.setdefault(column.path_in_schema, []).append(column)
            rows = []
            for name, chunks in columns.items():
                known = [chunk.statistics for chunk in chunks if chunk.is_stats_set]
                nulls = [s.null_count for s in known if s.has_null_count]
                ranges = [s for s in known if s.has_min_max]
                # A chunk of nulls alone has no range; any other chunk without one leaves the column's open.
                whole = all(s.has_min_max or s.null_count == chunk.num_values for chunk, s in zip(chunks, known)) and len(known) == len(chunks)
                rows.append((
                    path, size, footer.num_row_groups, footer.num_rows, name, sum(chunk.total_compressed_size for chunk in chunks),
                    sum(nulls) if len(nulls) == len(chunks) else None,
                    _text(min(s.min for s in ranges)) if whole and ranges else None, _text(max(s.max for s in ranges)) if whole and ranges else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(zip(*rows), _ARROW)], schema=_ARROW)


_ARROW = pa.schema([
    ("file", pa.string()), ("file_bytes", pa.int64()), ("row_groups", pa.int32()), ("n_rows", pa.int64()), ("column_name", pa.string()),
    ("stored_bytes", pa.int64()), ("null_count", pa.int64()), ("low", pa.string()), ("high", pa.string()),
])


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row per Parquet file below ``path`` and column, read from the footers in tasks.

    Rows, row groups, stored bytes, null count, and the range as text where every row group states it. Files are
    listed by Spark and opened in tasks through Arrow, so the store must be one that Arrow opens.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    )
    return listed.mapInArrow(_read_footers, COLUMN_SCHEMA)

