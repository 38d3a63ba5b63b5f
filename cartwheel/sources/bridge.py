"""Bridge from the driver's test tables to the engine's inputs.

``events`` becomes the behaviour log and ``part`` the target item subset; a
``lineitem`` join ``orders`` log serves load tests. The rules are the fixture
rules of FIXTURES.md section 3 and are mirrored by the DuckDB oracle SQL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the fixture bridge ---
BLOCK_USERS, BLOCK_ITEMS = 5, 66   # five users share a block of items: item_id = (user_id div 5) * 66 + props.k div 2
CATEGORY_MODULUS = 6         # item_category = item_id % 6
TARGET_SIZE_ABOVE = 10       # P = parts of a size above 10 (four in five, at every scale)
FANOUT_SIZE_ABOVE = 45       # fan-out variant repeats the parts of a size above 45
BEHAVIOUR_OF_EVENT = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}
SHIFT_MODULUS = 7            # users fall into seven groups by id ...
SHIFT_DAYS = {1: 4, 3: 4, 5: 5}   # ... three of which were last seen days before the others
LABEL_DATE = _dt.date(2024, 1, 30)
LOAD_LABEL_DATE = _dt.date(2001, 8, 1)
LOAD_CATEGORY_MODULUS = 25
LOAD_DAYS = 30               # order days are folded onto the 30 days up to the label date
LOAD_BLOCK_USERS, LOAD_BLOCK_ITEMS = 15, 20   # 15 customers share a block of 20 parts
# --- end of fixed values ---


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def actions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour log from the whole of ``events``."""
    ev = table(spark, sf_dir, "events")
    behaviour = F.lit(None).cast("short")
    for name, code in BEHAVIOUR_OF_EVENT.items():
        behaviour = F.when(F.col("event_type") == name, F.lit(code).cast("short")).otherwise(behaviour)
    user = F.col("user_id").cast("bigint")
    item = F.floor(user / BLOCK_USERS) * BLOCK_ITEMS + F.floor(F.get_json_object("props", "$.k").cast("bigint") / 2)
    shift = F.lit(0)
    for group, days in SHIFT_DAYS.items():
        shift = F.when(F.pmod(user, F.lit(SHIFT_MODULUS)) == group, F.lit(days)).otherwise(shift)
    return ev.select(
        user.alias("user_id"),
        item.alias("item_id"),
        behaviour.alias("behavior_type"),
        F.lit(None).cast("string").alias("user_geohash"),
        (item % CATEGORY_MODULUS).alias("item_category"),
        F.date_sub(F.to_date("ts"), shift).alias("dt"),
    )


def target_items_from_part(spark: SparkSession, sf_dir: str, fanout: bool = False) -> DataFrame:
    """Item subset P from ``part``; ``fanout`` repeats some items."""
    parts = table(spark, sf_dir, "part").where(F.col("p_size") > TARGET_SIZE_ABOVE)
    if fanout:
        parts = parts.unionAll(parts.where(F.col("p_size") > FANOUT_SIZE_ABOVE))
    return parts.select(
        F.col("p_partkey").alias("item_id"),
        (F.col("p_partkey") % CATEGORY_MODULUS).alias("item_category"),
    )


def actions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger log for load tests: one row per line item of an order. Order days
    are folded onto a month and parts mapped to blocks of customers, so every
    line item counts and pairs repeat."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    item = F.floor(F.col("o_custkey") / LOAD_BLOCK_USERS) * LOAD_BLOCK_ITEMS + F.pmod(F.col("l_partkey"), F.lit(LOAD_BLOCK_ITEMS))
    last = F.lit(LOAD_LABEL_DATE.isoformat()).cast("date")
    return j.select(
        F.col("o_custkey").alias("user_id"),
        item.alias("item_id"),
        (1 + F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(4))).cast("short").alias("behavior_type"),
        F.lit(None).cast("string").alias("user_geohash"),
        F.pmod(item, F.lit(LOAD_CATEGORY_MODULUS)).alias("item_category"),
        F.date_sub(last, F.pmod(F.datediff(last, F.to_date("o_orderdate")), F.lit(LOAD_DAYS))).alias("dt"),
    )


def items_from_part_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-test item subset: every part, category as in ``actions_from_orders``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.pmod(F.col("p_partkey"), F.lit(LOAD_CATEGORY_MODULUS)).alias("item_category"),
    )
