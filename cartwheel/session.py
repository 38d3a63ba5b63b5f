"""SparkSession helpers.

On a cluster the session comes from the launcher; these helpers only fill in
settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Applied with ``setdefault`` semantics.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cartwheel") -> SparkSession:
    """Return the active session, or build a local one for tests / benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that every "
                               "executor shares (lineage cuts and stage tables are written there)")
        # Local mode only (tests, benches): one machine, so a local folder is shared.
        configured = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts (checkpoint / written tables)."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cartwheel-{name}-{uuid.uuid4().hex[:12]}"
    for paths in _SCOPES.get():
        paths.append(path)
    return path


# The open scopes of the running thread of work: another thread's tables aren't theirs.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("cartwheel-scopes", default=())


# Bucketed tables by folder: a reader of the folder can use their buckets.
_TABLES: dict[str, str] = {}


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table from the file system that holds it."""
    if path in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables named inside are removed at the end: their readers have
    to be done by then (results written elsewhere, or collected)."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            remove(spark, path)


def write_bucketed(df: DataFrame, path: str, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Writes ``df`` in buckets of its key columns and returns the table: joins and
    aggregates on all of the columns need no shuffle of it. One file a bucket.
    The number of buckets is that of a shuffle, unless given. Keys are spread by
    all the columns, so bucketing by (user, item) splits a hot user's rows."""
    spark = df.sparkSession
    n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions", "200"))
    name = f"cartwheel_{uuid.uuid4().hex}"
    remove(spark, path)
    (df.repartition(n, *columns).write.format("parquet").bucketBy(n, *columns).sortBy(*columns)
     .option("path", path).saveAsTable(name))
    _TABLES[path] = name
    return spark.table(name)


def bucketed_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The bucketed table that this session wrote to a folder, if it did."""
    name = _TABLES.get(path)
    return spark.table(name) if name and spark.catalog.tableExists(name) else None


def read_bucketed(spark: SparkSession, path: str, schema, columns: Sequence[str], buckets: int) -> DataFrame:
    """A bucketed table written by another session."""
    name = f"cartwheel_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in columns)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def materialize_bucketed(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """``materialize`` into buckets of key columns."""
    return write_bucketed(df, scratch_path(df.sparkSession, name), columns)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: a lineage cut for intermediates that several branches reuse
    (each branch then scans the table instead of recomputing its lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
