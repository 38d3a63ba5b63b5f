"""The hand-worked example of FIXTURES.md section 2 (test input only)."""

import datetime as dt

L = dt.date(2014, 12, 18)

# P: item 12 listed twice
ITEMS = [(10, 7), (11, 7), (12, 8), (12, 8)]

# (day, user, item, behaviour, category)
LOG = [
    ("2014-12-03", 1, 10, 2, 7),
    ("2014-12-04", 1, 11, 3, 7),
    ("2014-12-10", 1, 12, 1, 8),
    ("2014-12-11", 2, 10, 1, 7),
    ("2014-12-17", 1, 10, 1, 7),
    ("2014-12-17", 1, 10, 1, 7),
    ("2014-12-17", 1, 99, 4, 9),
    ("2014-12-18", 1, 10, 4, 7),
    ("2014-12-18", 2, 12, 4, 8),
]


def frames(spark):
    from pyspark.sql import functions as F
    actions = spark.createDataFrame(
        [(u, i, b, None, c, d) for d, u, i, b, c in LOG],
        "user_id bigint, item_id bigint, behavior_type short, user_geohash string, item_category bigint, d string",
    ).withColumn("dt", F.to_date("d")).drop("d")
    items = spark.createDataFrame(ITEMS, "item_id bigint, item_category bigint")
    return actions, items
