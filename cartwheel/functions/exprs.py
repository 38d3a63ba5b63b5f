"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.schemas import NEVER_DAYS, STRONG_GAP_DAYS


def lit_date(d) -> Column:
    return F.lit(str(d)).cast("date")


def safe_div(num, den) -> Column:
    """``num / den`` as DOUBLE, 0.0 when ``den <= 0`` (ANSI mode raises on /0)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def days_since(ref, day_col) -> Column:
    """``ref - day`` in days (INT); 999 when the day is null (never seen)."""
    day_col = F.col(day_col) if isinstance(day_col, str) else day_col
    return F.coalesce(F.datediff(lit_date(ref), day_col), F.lit(NEVER_DAYS)).cast("int")


def with_missing_as_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F16: add absent rule columns as 0."""
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0))
    return df


def strong_rule(df: DataFrame) -> Column:
    """F8: cart>0 or collect>0 or user recent_3d>0 or pair gap<=3 or pair buys>0.

    Absent columns count as 0 (an absent gap column makes every row strong),
    nulls count as 0 as well.
    """
    def c(name):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0)) if name in df.columns else F.lit(0)

    return (
        (c("ui_cart_count") > 0)
        | (c("ui_collect_count") > 0)
        | (c("recent_3d_actions") > 0)
        | (c("ui_days_since_last_action") <= STRONG_GAP_DAYS)
        | (c("ui_purchase_count") > 0)
    )



def bucket_index(value, bounds: Sequence[int]) -> Column:
    """Bucket of an integer gap: ``(-inf,b0] -> 0, (b0,b1] -> 1, ... (last,inf) -> n``.

    Null goes to the last bucket. Closed on the right, unlike ``Bucketizer``.
    """
    value = F.col(value) if isinstance(value, str) else value
    v = value.cast("bigint")
    expr = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        expr = F.when(v <= F.lit(int(bounds[i])), F.lit(i)).otherwise(expr)
    return F.when(v.isNull(), F.lit(len(bounds))).otherwise(expr).cast("int")


def hash_order(seed: int, *cols: str) -> Column:
    """Repeatable random order key: ``md5(concat_ws('_', cols..., seed))``.

    Equal under any partitioning and equal to DuckDB's ``md5`` of the same text.
    """
    return F.md5(F.concat_ws("_", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def hash_prefix(seed: int, *cols: str) -> Column:
    """First 8 hex digits of ``hash_order`` as a number: orders rows exactly as
    the md5 text does on its leading digits (used to pre-filter cuts)."""
    return F.conv(F.substring(hash_order(seed, *cols), 1, 8), 16, 10).cast("bigint")


def hash_bucket(seed: int, k: int, *cols: str) -> Column:
    """``(first 8 hex digits of hash_order) mod k``: a repeatable fold / shard id."""
    h = F.conv(F.substring(hash_order(seed, *cols), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(int(k))).cast("int")


def stand_in_score() -> Column:
    """Deterministic score that SQL can reproduce (FIXTURES.md section 4)."""
    base = F.pmod(F.col("user_id") * 7919 + F.col("item_id") * 104729, F.lit(10007))
    bonus = (
        F.lit(5000) * F.least(F.col("ui_cart_count"), F.lit(1))
        + F.lit(2500) * F.least(F.col("ui_collect_count"), F.lit(1))
    )
    return ((base + bonus).cast("double") / F.lit(20000.0)).alias("pred_prob")


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Every numeric null becomes 0."""
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("long", "integer", "short", "double", "float", "byte", "decimal")]
    return df.na.fill(0, subset=numeric)
