"""File sources: CSV, JSON and Parquet, alone or as a tree of monthly files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# The naming pattern of monthly trip files.
MONTHLY_FILE = r"(yellow|green|fhv)_tripdata_(\d{4})-(\d{2})\."


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """CSV files with a header; without a schema every column is text.

    Columns past the declared ones are ignored, unreadable values become NULL.
    ``.gz`` files are read by one task each, since gzip cannot be split: ``spread``
    deals their rows to all tasks.
    """
    reader = spark.read.option("header", True).option("timestampFormat", CSV_TIME_FORMAT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


# Field that holds the text of a malformed CSV row.
MALFORMED = "_malformed"


def read_csv_checked(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files that hold exactly the declared columns and readable values, and all others.

    The others come with their file, reason and text: ``short`` or ``long`` rows by their number of fields,
    ``unreadable`` where a value is not of its type. Every line is in one of the two, but for empty lines and
    header lines, that is, lines that list the declared names. A row is one line; quotes within quotes are doubled.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"))
    header = ",".join(field.name for field in schema)
    whole = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "timestampFormat": CSV_TIME_FORMAT, "escape": '"'}
    rows = lines.filter((F.trim("value") != "") & (F.col("value") != header)).select(
        "file", "value", F.from_csv("value", F.lit(whole.simpleString()), options).alias("row"))
    fields, wanted = _fields(F.col("value")), len(schema)
    reason = F.when(fields < wanted, "short").when(fields > wanted, "long").when(F.col(f"row.{MALFORMED}").isNotNull(), "unreadable")
    judged = rows.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[F.col(f"row.{field.name}").alias(field.name) for field in schema])
    return good, judged.filter(F.col("reason").isNotNull()).select("file", "reason", F.col("value").alias("line"))


def _fields(line: Column) -> Column:
    """Number of fields of a CSV row; separators between quotes do not count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly to tasks, as after a read of files that cannot be split."""
    return df.hint("rebalance")


def inferred_schema(spark: SparkSession, path: str, sampling_ratio: float = 0.1) -> StructType:
    """Schema guessed from a sample of the rows, to be frozen for typed reads."""
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .option("samplingRatio", sampling_ratio).csv(path).schema
    )


def read_products(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Rows of the ``products`` array of JSON documents.

    One document per line splits across tasks; ``multi_line`` reads whole files.
    """
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents.select(F.inline("products"))


def external_view(spark: SparkSession, name: str, paths: str | Sequence[str], schema: StructType | None = None, file_format: str = "parquet") -> DataFrame:
    """Register files under a view name without copying them."""
    if file_format == "csv":
        df = read_csv(spark, paths, schema)
    else:
        reader = spark.read.format(file_format)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(paths if isinstance(paths, str) else list(paths))
    df.createOrReplaceTempView(name)
    return df


def file_name() -> Column:
    """Name of the monthly file a row was read from.

    A folder of part files that carries a monthly name counts as that file; any
    other source gives the plain file name.
    """
    monthly = F.regexp_extract(F.col("_metadata.file_path"), f"({MONTHLY_FILE}[^/]*)", 1)
    return F.coalesce(F.nullif(monthly, F.lit("")), F.col("_metadata.file_name"))


def with_file_period(df: DataFrame) -> DataFrame:
    """Add file name, taxi type, year and month as the file's path spells them."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        file_name().alias("source_file"),
        F.regexp_extract(path, MONTHLY_FILE, 1).alias("taxi_type"),
        F.regexp_extract(path, MONTHLY_FILE, 2).try_cast("int").alias("year"),
        F.regexp_extract(path, MONTHLY_FILE, 3).try_cast("int").alias("month"),
    )


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file each row came from and the time of the load."""
    return df.select("*", file_name().alias("source_file"), F.current_timestamp().alias("ingestion_timestamp"))


def monthly_glob(root: str, taxi_type: str = "both", years: Sequence[int] = (), months: Sequence[int] = ()) -> str:
    """Path glob of the monthly files of a type, some years and some months; empty means all."""
    types = ["yellow", "green"] if taxi_type == "both" else [taxi_type]
    year_globs = [f"{year:04d}" for year in years] or ["[0-9][0-9][0-9][0-9]"]
    month_globs = [f"{month:02d}" for month in months] or ["[0-9][0-9]"]
    return "%s/*{%s}_tripdata_{%s}-{%s}.*" % (
        root, ",".join(types), ",".join(year_globs), ",".join(month_globs)
    )


def read_monthly(
    spark: SparkSession, root: str, schema: StructType, taxi_type: str = "both",
    years: Sequence[int] = (), months: Sequence[int] = (), file_format: str = "csv",
) -> DataFrame:
    """All monthly files under ``root`` (which may hold ``*``) of a type, some years and months.

    The choice is a path glob, so other files are neither opened nor listed.
    """
    path = monthly_glob(root, taxi_type, years, months)
    if file_format == "csv":
        return with_file_period(read_csv(spark, path, schema))
    return with_file_period(spark.read.schema(schema).format(file_format).load(path))


def column_summary(df: DataFrame) -> DataFrame:
    """Name, type and number of non-NULL values of every column, in one pass."""
    counted = df.agg(*[F.count(name).alias(name) for name in df.columns])
    lines = counted.unpivot([], df.columns, "column_name", "non_null_rows")
    type_name = F.lit(None).cast("string")
    for name, dtype in df.dtypes:
        type_name = F.when(F.col("column_name") == name, dtype).otherwise(type_name)
    return lines.withColumn("data_type", type_name)


def table_list(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """Tables and views of the current catalog with their row counts."""
    listed = [table.name for table in spark.catalog.listTables()]
    chosen = sorted(name for name in listed if names is None or name in names)
    if not chosen:
        return spark.createDataFrame([], "table_name string, n_rows bigint")
    counts = [
        spark.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in chosen
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
