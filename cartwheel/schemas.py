"""Schemas, column lists and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original pipeline's for equal results) ---
# behaviour codes: 1 view, 2 collect, 3 cart, 4 purchase
VIEW, COLLECT, CART, PURCHASE = 1, 2, 3, 4
STRONG_BEHAVIOURS = (2, 3)
NEVER_DAYS = 999                     # day gap used for "never seen"
RECENT_DAYS, STRONG_DAYS = 7, 14     # recall windows, days before the reference day
USER_RECENT_LONG, USER_RECENT_SHORT = 7, 3   # trailing feature windows
STRONG_GAP_DAYS = 3                  # strong-pair rule: pair gap <= 3
TWO_STAGE_K_GRID = (3, 5, 8, 10, 12, 15)
TWO_STAGE_M_GRID = (0, 1, 2, 3, 5)
THRESHOLD_GRID_POINTS = 25
THRESHOLD_GRID_QUANTILES = (0.90, 0.999)
TIME_GAP_FEATURES = (
    "days_since_last_action",
    "ui_days_since_last_action",
    "recent_3d_actions",
    "recent_7d_actions",
    "recent_7d_views",
    "recent_3d_views",
)

# Names that must match: input schemas, feature columns, output columns.
KEY = ["user_id", "item_id"]

ACTIONS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("item_id", T.LongType(), False),
    T.StructField("behavior_type", T.ShortType(), False),
    T.StructField("user_geohash", T.StringType(), True),
    T.StructField("item_category", T.LongType(), False),
])

ITEMS_RAW_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType(), False),
    T.StructField("item_geohash", T.StringType(), True),
    T.StructField("item_category", T.LongType(), False),
])

USER_FEATURES = [
    "user_total_actions",
    "behavior_1_count", "behavior_2_count", "behavior_3_count", "behavior_4_count",
    "purchase_rate", "active_days", "avg_actions_per_day",
    "recent_7d_actions", "recent_3d_actions",
    "days_since_last_action", "unique_categories",
]
ITEM_FEATURES = [
    "item_total_actions", "total_purchases", "unique_users", "views",
    "conversion_rate", "avg_actions_per_user",
    "recent_7d_views", "recent_3d_views", "days_since_last_view",
    "item_category",
]
PAIR_FEATURES = [
    "ui_total_actions", "ui_view_count", "ui_collect_count", "ui_cart_count",
    "ui_purchase_count", "ui_days_since_last_action", "ui_action_span_days",
    "ui_avg_actions_per_day",
]
USER_CATEGORY_FEATURES = ["user_category_actions", "user_category_items"]
FEATURE_COLUMNS = USER_FEATURES + ITEM_FEATURES + PAIR_FEATURES + USER_CATEGORY_FEATURES

# Names used by the CSV files of the original pipeline (colliding totals).
CSV_RENAMES = {"user_total_actions": "total_actions_x", "item_total_actions": "total_actions_y"}

STRONG_RULE_COLUMNS = [
    "ui_cart_count", "ui_collect_count", "recent_3d_actions",
    "ui_days_since_last_action", "ui_purchase_count",
]
# --- end of fixed values ---
