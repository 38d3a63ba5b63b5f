"""Incremental landing of daily log shards with Structured Streaming.

The original scans its day files one by one ("streaming" in its own words).
Here a file-source stream picks up new ``data_YYYYMMDD*.txt`` files as they
arrive and appends them to the ``dt``-partitioned Parquet table that every
batch stage reads. ``availableNow`` processes whatever is present and stops,
so the same code serves a daily scheduled run and a backfill; the checkpoint
records which files were already landed (exactly-once per file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.schemas import ACTIONS_SCHEMA
from cartwheel.sources.daily_logs import SHARD_GLOB, shard_date


def daily_shard_stream(spark: SparkSession, daily_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming DataFrame over the shard folder (one day per micro-batch by default)."""
    raw = (
        spark.readStream.schema(ACTIONS_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", SHARD_GLOB)
        .option("maxFilesPerTrigger", int(max_files_per_trigger))
        .csv(daily_dir)
    )
    return raw.withColumn("dt", shard_date(F.col("_metadata.file_name"))).where(F.col("dt").isNotNull())


def land_daily_stream(spark: SparkSession, daily_dir: str, out_path: str,
                      checkpoint_location: str | None = None,
                      max_files_per_trigger: int = 1) -> StreamingQuery:
    """Append new shards to ``out_path`` (Parquet, partitioned by ``dt``).

    Returns the started query; with ``availableNow`` it ends by itself after
    the files present at start are landed (``query.awaitTermination()``).
    """
    # Default next to the data (hidden from readers by the "_" prefix), so a
    # rerun resumes and lands only files it has not seen.
    ckpt = checkpoint_location or f"{out_path.rstrip('/')}/_checkpoint"
    return (
        daily_shard_stream(spark, daily_dir, max_files_per_trigger)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", ckpt)
        .partitionBy("dt")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
