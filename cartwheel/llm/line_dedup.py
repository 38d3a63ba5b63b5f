"""Operator 13: line dedup by levelled sorted runs.

A line's key is the line without white space at its ends and with A-Z in lower
case; keys of at least ``min_chars`` code points that at least ``min_docs``
documents hold keep their lines only in the document with the largest id.

One scan writes an occurrence (id, text hash, line number, 128-bit key hash) for
every line that is long enough, dealt into batches of descending id. The store
is a set of runs: tables of (key hash, documents), bucketed and sorted by the
hash. Each batch is reduced to one row a key (a key that a third of the
documents hold is combined in the map tasks), merge-anti-joined with the runs
of the batches before it, and written as a run of its own. A key that no run
holds is new: no larger id has it, so its largest id in the batch is its
keeper. Whenever a level holds ``fan`` runs they are merged into one of the
next level, which sums their counts. All runs share their buckets, so these
joins and merges move nothing between machines. At the end the runs' counts say
which keys are frequent; occurrences of frequent keys outside the keeper are
dropped (a join that AQE splits where a key is hot), and each text is put
together again from the pieces between its dropped lines.

DataFrame functions alone: no Python in any task.

Defined results: null and empty texts are one empty line; rows of one id are
one document (they count once, and all of them keep the line if it is the
largest); a null id is one document, smaller than all others; repeated rows
lose the same lines; long texts are split where they are read and their text
moves once; an empty table gives an empty table; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch, id_and_text
from cartwheel.session import remove, scratch_path

#: Batches that the table is dealt into, and runs of a level that are merged.
BATCHES, FAN = 4, 2
#: Characters stripped from a line's ends: blank, tab and line ends.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    key = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(key) == F.length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


class Runs:
    """Levelled runs of (h, n): key hashes with the number of documents that
    hold them, bucketed and sorted by the hash."""

    def __init__(self, spark: SparkSession, fan: int = FAN):
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        self.levels: list[list[tuple[str, str]]] = []
        self.merges = 0

    def table(self, df: DataFrame, name: str) -> tuple[str, str]:
        """Writes a bucketed, sorted table: its name and folder."""
        path, name = scratch_path(self.spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
        spread = df.repartition(self.buckets, "h")
        spread.write.bucketBy(self.buckets, "h").sortBy("h").option("path", path).format("parquet").saveAsTable(name)
        return name, path

    def drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        remove(self.spark, run[1])

    def all(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows whose hash no run holds: one merge-anti-join a run."""
        for name, _ in self.all():
            keys = keys.join(self.spark.table(name).select("h").hint("merge"), "h", "left_anti")
        return keys

    def add(self, run: tuple[str, str], level: int = 0) -> None:
        """Adds a run; a full level is merged into a run of the next."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan:
            full, self.levels[level] = self.levels[level], []
            merged = self.table(self._merged(full), f"line-run-{level + 1}")
            self.merges += 1
            for old in full:
                self.drop(old)
            self.add(merged, level + 1)

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        rows = None
        for name, _ in runs:
            one = self.spark.table(name).select("h", "n")
            rows = one if rows is None else rows.unionAll(one)
        return rows.groupBy("h").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        """h and the documents that hold it, over all runs."""
        return self._merged(self.all())

    def close(self) -> None:
        for run in self.all():
            self.drop(run)
        self.levels = []


def _bounds(texts: DataFrame, batches: int) -> list[int]:
    """Ids that part the table into batches of about one size."""
    shares = [k / batches for k in range(1, batches)]
    if not shares:
        return []
    found = texts.agg(F.percentile_approx("doc_id", shares, 1000).alias("q")).first()["q"]
    return sorted(set(found or []), reverse=True)


def occurrences(texts: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, t (hash of the text), pos and h of every line that is long enough."""
    lines = texts.select("doc_id", F.unhex(F.md5("text")).alias("t"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    key = lines.select("doc_id", "t", "pos", line_key(F.col("line")).alias("key"))
    return key.where(F.length("key") >= min_chars).select("doc_id", "t", "pos", F.unhex(F.md5("key")).alias("h"))


def _dropped(texts: DataFrame, min_chars: int, min_docs: int, batches: int, fan: int, scratch: Scratch) -> DataFrame:
    """doc_id, t and pos of every line that goes."""
    spark = texts.sparkSession
    bounds = _bounds(texts, batches)
    batch = sum((F.when(F.col("doc_id") > b, 0).otherwise(1) for b in bounds), F.lit(0))
    path = scratch_path(spark, "line-occurrences")
    occurrences(texts, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    found = spark.read.schema("doc_id long, t binary, pos int, h binary, batch int").parquet(path)
    runs, keepers = Runs(spark, fan), []
    for k in range(len(bounds) + 1):
        here = found.where(F.col("batch") == k).select("h", "doc_id").distinct()
        run = runs.table(here.groupBy("h").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id")), "line-run-0")
        keepers.append(scratch.write(runs.unseen(spark.table(run[0]).select("h", "keep_id")), f"line-keepers-{k}"))
        runs.add(run)
    kept = keepers[0]
    for more in keepers[1:]:
        kept = kept.unionAll(more)
    often = runs.counts().where(F.col("n") >= min_docs).select("h")
    verdict = scratch.write(often.join(kept, "h").select("h", "keep_id"), "line-verdicts")
    runs.close()
    scratch.drop(*keepers)
    out = found.join(verdict, "h").where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "t", "pos")
    return out


def remove_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                          text_col: str = "text", batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_lines, dropped (the line numbers
    that go, from 0) and kept (the text that stays)."""
    texts = id_and_text(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession)
    gone = (_dropped(texts, min_chars, min_docs, batches, fan, scratch).groupBy("doc_id", "t")
            .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
            .select(F.col("doc_id").alias("g_id"), F.col("t").alias("g_t"), "dropped"))
    gone = scratch.write(gone, "line-dropped")
    here = texts.withColumn("t", F.unhex(F.md5("text")))
    rows = here.join(gone, here["doc_id"].eqNullSafe(gone["g_id"]) & (here["t"] == gone["g_t"]), "left")
    rows = rows.select("doc_id", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    lines = _lines(F.col("text"))
    start = F.concat(F.array(F.lit(0)), F.transform("dropped", lambda p: p + 1))
    end = F.concat("dropped", F.array(F.col("n_lines")))
    pieces = F.zip_with(start, end, lambda s, e: F.slice(F.col("lines"), s + 1, e - s))
    split = rows.withColumn("lines", lines).withColumn("n_lines", F.size("lines"))
    kept = F.when(F.size("dropped") == 0, F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return split.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), "dropped", kept.alias("kept"))
