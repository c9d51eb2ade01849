"""File streams and parquet sinks under the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from tabforge.session import scratch_dir

#: Marks the row that only moves the watermark past all others.
FLUSH = "__flush"


def read_stream(
    spark: SparkSession, path: str, schema: StructType | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of a parquet table: a folder or glob that keeps receiving files."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def start(stream: DataFrame, output: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Append the stream to a parquet folder; the file sink's log makes a retried batch appear once."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(output)


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch; it must be safe to repeat for the same id."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process everything that is there now and read the result back as a table."""
    spark = stream.sparkSession
    base = scratch_dir(spark, name)
    query = start(stream, f"{base}/out", f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def with_flush(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` joined by a folder that ``flush`` writes to once the stream has ended."""
    spark, schema = stream.sparkSession, StructType([*stream.schema.fields, StructField(FLUSH, BooleanType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    return stream.withColumn(FLUSH, F.lit(False)).unionByName(read_stream(spark, folder, schema))


def flush(spark: SparkSession, folder: str, schema: StructType, date: str) -> None:
    """End a stream made by ``with_flush``: its next run finds a row beyond all times, so nothing waits any longer."""
    end = F.to_timestamp(F.lit("9999-01-01 00:00:00"))
    fields = [(end if f.name == date else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*fields, F.lit(True).alias(FLUSH)).write.mode("append").parquet(folder)


def run_to_end(stream: DataFrame, date: str, make: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Process everything that is there and what still waits for late rows, and read the result of ``make`` back as a table."""
    spark = stream.sparkSession
    base = scratch_dir(spark, name)
    out = make(with_flush(stream, f"{base}/flush"))
    for last in (False, True):
        if last:
            flush(spark, f"{base}/flush", stream.schema, date)
        start(out, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")
