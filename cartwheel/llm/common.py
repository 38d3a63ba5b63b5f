"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_path

#: Rows of a mapped slice: keeps a Python worker's memory to a few MB of text
#: whatever the size of Arrow's batches.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads (a null text is an empty one); other
    columns, whatever their names, stay outside the operator."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` in slices of ``SLICE_ROWS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = fn(batch.slice(at, SLICE_ROWS))
                if out is not None:
                    yield out
    return df.mapInArrow(run, schema)


class Scratch:
    """Tables an operator writes for itself in the shared checkpoint folder.

    A written table cuts lineage and outlives lost executors. ``drop`` removes
    one once its last reader has been written; the table behind a returned
    DataFrame has to stay until the caller has read it. The shuffle files of a
    finished write go with it, where Spark has the setting for that."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.write_path(df, name, **options))

    def write_path(self, df: DataFrame, name: str, **options: str) -> str:
        path = scratch_path(self.spark, name)
        before = self.spark.conf.get(self.CLEANUP, None)
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.options(**options).parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, before or "false")
        return path

    def drop(self, *frames: DataFrame) -> None:
        fs_of = self.spark._jvm.org.apache.hadoop.fs.Path
        for frame in frames:
            for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
                path = fs_of(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def null_safe(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Join condition that holds for equal values and for two nulls."""
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond
