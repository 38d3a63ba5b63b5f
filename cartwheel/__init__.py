"""cartwheel: a Spark-native engine for next-day purchase prediction.

Every operator is a function ``DataFrame(s) + keyword parameters -> DataFrame``
built from Spark SQL expressions; Catalyst and AQE pick the physical plan.

Sub-packages
------------
sources    readers/writers for the daily behaviour log, the item subset and
           stage outputs; a bridge from the driver's test tables.
functions  column expressions and distributed ranking helpers.
operators  recall, features, sampling, strategies, metrics, tuning, scoring.
plans      parameters, the three stage runners and the query catalogue.
streaming  incremental landing of daily shards with Structured Streaming.
"""

from cartwheel.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
