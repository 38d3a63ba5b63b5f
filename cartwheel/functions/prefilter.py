"""A cheap filter in front of a shuffle: rows whose key can't be among ``keys``.

A Bloom filter with one hash function, held as a hash table of buckets: the
distinct ``xxhash64(key) mod 2**BITS`` of the keys, broadcast, semi-joined in the
map tasks that read the rows. False positives pass, so an exact semi-join
follows where the rows are fewer. The broadcast is bounded by ``MOST_BUCKETS``
integers, whatever the keys; where the keys fill more buckets the filter would
let too much through, and the rows are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 20
MOST_BUCKETS = 1 << (BITS - 1)


def bucket(column: str):
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << BITS)).cast("int")


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` without those whose ``column`` is surely not in ``keys``."""
    buckets = keys.select(bucket(column).alias("_bucket")).distinct()
    if buckets.limit(MOST_BUCKETS + 1).count() > MOST_BUCKETS:
        return rows
    return (rows.withColumn("_bucket", bucket(column))
            .join(F.broadcast(buckets), "_bucket", "left_semi").drop("_bucket"))
