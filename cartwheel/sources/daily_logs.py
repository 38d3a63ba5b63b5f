"""Daily behaviour-log shards.

The log arrives as one headerless TSV per day, ``data_YYYYMMDD.txt``, with no
time column: the day comes from the file name. Reading it raw gives no
partition pruning (the day is derived from ``_metadata``), so the first step
lands the shards once as Parquet partitioned by ``dt``; every later job reads
that table and Catalyst prunes whole days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import ACTIONS_SCHEMA

# File names: "data_" + 8 digits (a yyyyMMdd day) + anything + ".txt".
SHARD_GLOB = "data_[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9]*.txt"


def shard_date(file_name: Column) -> Column:
    """Day encoded in characters 6..13 of the shard name; null if not a date."""
    return F.try_to_timestamp(F.substring(file_name, 6, 8), F.lit("yyyyMMdd")).cast("date")


def read_daily_shards(spark: SparkSession, daily_dir: str) -> DataFrame:
    """S1 + S2: all shards of a folder as one DataFrame with a ``dt`` column.

    Fixed schema, tab separated, no header; a malformed number fails the read
    (FAILFAST), as the original reader does. Names that match the glob but do
    not hold a real date are skipped.
    """
    raw = (
        spark.read.schema(ACTIONS_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", SHARD_GLOB)
        .csv(daily_dir)
    )
    return (
        raw.withColumn("dt", shard_date(F.col("_metadata.file_name")))
        .where(F.col("dt").isNotNull())
    )


def land_daily_shards(spark: SparkSession, daily_dir: str, out_path: str,
                      mode: str = "overwrite", max_records_per_file: int = 20_000_000) -> None:
    """Write the shards as Parquet partitioned by ``dt`` (enables day pruning).

    No shuffle: every input split comes from one day file, so each read task
    writes into exactly one ``dt`` folder. (A ``repartition("dt")`` would send
    a whole day -- terabytes at scale -- through a single task.) File sizes
    are bounded by ``maxRecordsPerFile``.
    """
    (
        read_daily_shards(spark, daily_dir)
        .write.mode(mode)
        .option("maxRecordsPerFile", int(max_records_per_file))
        .partitionBy("dt")
        .parquet(out_path)
    )


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Landed actions table: ``user_id, item_id, behavior_type, user_geohash,
    item_category, dt``."""
    return spark.read.parquet(path)


def actions_on_day(actions: DataFrame, day) -> DataFrame:
    """One day's rows; on a ``dt``-partitioned table only that folder is read.

    A missing day simply yields no rows, which makes every anti-join against it
    a no-op (the original skips the step when the file is missing).
    """
    return actions.where(F.col("dt") == F.lit(day).cast("date"))


def actions_between(actions: DataFrame, start, end) -> DataFrame:
    """inclusive day range ``start <= dt <= end``."""
    return actions.where(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def actions_before(actions: DataFrame, ref) -> DataFrame:
    """point-in-time cut, only days strictly before ``ref`` (leak guard)."""
    return actions.where(F.col("dt") < F.lit(ref).cast("date"))
