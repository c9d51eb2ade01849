"""Helpers the training-data operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import materialise

#: Rows of one Arrow batch; texts can be long, so batches are kept far smaller than the default.
BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches that hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; an extra column of the same name in the input gives way."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])


def step(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder, read it back, and let go of the shuffle files it took.

    Spark removes a finished shuffle's files when the driver's JVM finds it unused, by itself half an hour
    later. Jobs of many steps would fill the disks with shuffles that nobody reads any more.
    """
    out = materialise(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a table that ``step`` wrote and that no later step reads."""
    files = df.inputFiles()
    if files:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
