"""Incremental landing: new payload files -> raw rows, exactly once.

The batch loads of the reference replace whole tables. When payload files
keep arriving in a landing folder, the same flattening operators run as a
Structured Streaming query over the folder: each new file is read whole, the
flatten function (any of :mod:`strata.sources.landing`) turns it into rows,
and a file sink appends them. The checkpoint (a folder of the output by
default, so a later run into the same output continues it) records which files were processed, so a restarted or failed job
neither skips nor repeats a file. The transformation is stateless, so there
is no watermark and no state store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def payload_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of (payload, source_file), one row per new file."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select(F.col("value").alias("payload"),
                                          F.col("_metadata.file_path").alias("source_file"))


def land_incrementally(spark: SparkSession, source_dir: str, output_path: str,
                       flatten: Callable[[DataFrame], DataFrame], checkpoint: str | None = None,
                       available_now: bool = True, partition_by: tuple[str, ...] = (),
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing query; with ``available_now`` it processes every file
    present and stops (a scheduled incremental batch)."""
    rows = flatten(payload_stream(spark, source_dir, max_files_per_trigger))
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", output_path)
              .option("checkpointLocation", checkpoint or f"{output_path.rstrip('/')}/_landing_checkpoint"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
