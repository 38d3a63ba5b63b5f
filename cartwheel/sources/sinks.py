"""Stage outputs.

Between stages the engine writes Parquet; CSV writers exist for files in the
original pipeline's format. Writers produce a folder of part files; none of
them funnels the data through the driver or a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import CSV_RENAMES
from cartwheel.session import bucketed_table, write_bucketed


def write_table(df: DataFrame, path: str, mode: str = "overwrite", bucket_by: Sequence[str] = ()) -> None:
    """S6 (Parquet form): stage output between jobs; also the lineage cut. With
    ``bucket_by`` the files are buckets of those columns: a later stage of the
    session that joins on them doesn't shuffle the table; any other reader sees
    plain Parquet."""
    if bucket_by:
        write_bucketed(df, path, bucket_by)
    else:
        df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S5 (Parquet form)."""
    found = bucketed_table(spark, path)
    return found if found is not None else spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, original_names: bool = True, mode: str = "overwrite") -> None:
    """S6 (CSV form): header, no index; feature totals renamed to ``_x/_y``."""
    out = df
    if original_names:
        for new, old in CSV_RENAMES.items():
            if new in out.columns:
                out = out.withColumnRenamed(new, old)
    out.write.mode(mode).option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S5 (CSV form): typed by ``schema`` if given, else inferred."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    for new, old in CSV_RENAMES.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def submission_rows(recs: DataFrame) -> DataFrame:
    """Distinct ``user_id, item_id`` pairs (the content of S7)."""
    return recs.select("user_id", "item_id").distinct()


def write_submission(recs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distinct pairs as headerless TSV (a folder of part files)."""
    submission_rows(recs).write.mode(mode).option("sep", "\t").option("header", "false").csv(path)


def write_embedding(emb: DataFrame, path: str, mode: str = "overwrite") -> None:
    """2-D embedding ``x, y, label`` as CSV with header."""
    emb.select(F.col("x"), F.col("y"), F.col("label")).write.mode(mode).option("header", "true").csv(path)
