"""Shared folder for tables a job writes on the way to its result.

Intermediate results that are read more than once are written as Parquet here
instead of being held by executors, so losing an executor costs a re-read and
not a recomputation.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-"))
    return context.getCheckpointDir()


_STORED: list[tuple[str, str]] = []


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses; ``release`` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _STORED.append((spark.sparkContext.applicationId, path))
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table is complete at ``path``."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the copy; ``codec`` replaces the session's compression."""
    path = new_dir(df.sparkSession, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of frames that no one holds any more.

    It hears of them when the driver collects its garbage, which a driver with little to do does
    rarely: between the passes of one job their files would add up.
    """
    gc.collect()
    spark._jvm.System.gc()


_BUILT: dict[tuple, str] = {}


def stamp(spark: SparkSession, *paths: str) -> tuple:
    """What tells one state of some files from another: their number, size, times and names."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return tuple(listed.agg(
        F.count("*"), F.sum("length"), F.max("modificationTime").cast("string"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string"),
    ).first())


def built_once(spark: SparkSession, key: tuple[str, ...], inputs: Sequence[str], build: Callable[[], str]) -> str:
    """Path of a stored table that several jobs of one application share.

    It is built anew when the files of its inputs have changed.
    """
    full = (spark.sparkContext.applicationId, *key, stamp(spark, *inputs))
    if full not in _BUILT:
        _BUILT[full] = build()
    return _BUILT[full]


def release(spark: SparkSession) -> None:
    """Delete the tables this application has stored here; frames that read them end with it."""
    application = spark.sparkContext.applicationId
    for path in [path for owner, path in _STORED if owner == application]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _STORED[:] = [entry for entry in _STORED if entry[0] != application]
    for full in [full for full in _BUILT if full[0] == application]:
        del _BUILT[full]
