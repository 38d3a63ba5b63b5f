"""Target item subset P (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.schemas import ITEMS_RAW_SCHEMA


def read_item_subset(spark: SparkSession, path: str) -> DataFrame:
    """Headerless TSV ``item_id, item_geohash, item_category``; keeps two columns.

    Duplicates are kept: an item listed with two geohashes stays twice, which
    the feature join later fans out (quirk reproduced on purpose).
    """
    return (
        spark.read.schema(ITEMS_RAW_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "FAILFAST")
        .csv(path)
        .select("item_id", "item_category")
    )


def item_set(items: DataFrame) -> DataFrame:
    """Distinct ``item_id`` of P (the set form used by the semi-joins)."""
    return items.select("item_id").distinct()
