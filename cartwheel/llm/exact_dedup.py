"""Operator 8: exact dedup.

Rows are grouped by the 128-bit hash (MD5) of their normalised text, and a
group keeps the row whose original text has most code points, of those the one
with the smallest id (null ids last). Before a group is believed, the
normalised texts of its members are compared with that of the row it keeps.
Members that differ (a collision of hashes) are regrouped by the text itself,
so the result is that of grouping by text.

Only ids, hashes and lengths are shuffled by hash. Texts move just for rows of
groups of two or more, and a large group is dealt out in shares of
``SHARE_ROWS`` rows, each with its own copy of the kept text.

Defined results: a null text counts as empty and equals every text that
normalises to ''; repeated rows (same id, same text) are members of one group,
of which ``keep_one`` keeps one; an empty table gives an empty table; other
columns are ignored by ``exact_groups`` and kept as they are by ``keep_one``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch, id_and_text, is_empty

#: Rows of a large group that one copy of its kept text is compared with.
SHARE_ROWS = 2000
#: Characters that normalising deletes: blank, tab and line ends.
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """Deletes white space (the six ASCII characters), for equality of texts."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _best() -> Column:
    """Of a group: its largest text's length, then the smallest id, nulls last; t names the text."""
    return F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "t"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash=lambda text: F.md5(text)) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_points (code points of the
    text), text_sha256 (of the normalised text), group_hash, keep_id,
    group_size and kept (true for the row that stays, and for its repeats)."""
    scratch = Scratch(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    norm = normalised(F.col("text"))
    rows = scratch.write(texts.select("doc_id", F.length("text").alias("n_points"), F.xxhash64("text").alias("t"),
                                      F.unhex(F.sha2(norm, 256)).alias("sha"),
                                      content_hash(norm.cast("binary")).alias("h")), "exact-rows")
    groups = scratch.write(rows.groupBy("h").agg(F.count("*").alias("n"), _best().alias("best")).where("n > 1")
                           .select("h", "n", F.col("best.doc_id").alias("keep_id"), F.col("best.t").alias("keep_t"),
                                   (-F.col("best.less")).alias("keep_points")), "exact-groups")
    bad = scratch.write(_collisions(texts, rows, groups, norm), "exact-collisions")
    bad = bad.where(content_hash(F.col("other").cast("binary")) == F.col("bad_h"))      # not another text of the same id
    if is_empty(bad):
        found = groups.select("h", F.lit(None).cast("string").alias("other"), "n", "keep_id", "keep_points")
        rows = rows.withColumn("other", F.lit(None).cast("string"))
    else:                           # a collision: the group's other texts become groups of their own
        rows = rows.join(bad, [rows.doc_id.eqNullSafe(bad.bad_id), rows.h == bad.bad_h, rows.sha == bad.bad_sha],
                         "left").drop("bad_id", "bad_h", "bad_sha")
        found = (rows.groupBy("h", "other").agg(F.count("*").alias("n"), _best().alias("best"))
                 .select("h", "other", "n", F.col("best.doc_id").alias("keep_id"),
                         (-F.col("best.less")).alias("keep_points")))
    g = found.select(F.col("h").alias("g_h"), F.col("other").alias("g_other"), "n", "keep_id", "keep_points")
    joined = rows.join(g, (rows.h == g.g_h) & rows.other.eqNullSafe(g.g_other), "left")
    alone = F.col("g_h").isNull()
    return joined.select(
        "doc_id", "n_points", F.lower(F.hex("sha")).alias("text_sha256"), F.col("h").alias("group_hash"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("n")).alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))).alias("kept"))


def _collisions(texts: DataFrame, rows: DataFrame, groups: DataFrame, norm: Column) -> DataFrame:
    """Rows whose normalised bytes differ from those of the row their group
    keeps: bad_id, bad_h, bad_sha and other, their normalised text."""
    shares = F.ceil(F.col("n") / SHARE_ROWS)
    # Members are told apart by id and text: repeated rows and null ids meet their own text alone.
    members = (rows.join(groups, "h")
               .withColumn("share", F.pmod(F.xxhash64("doc_id", "t"), shares)))
    # The kept row of a group once, with a copy for every share.
    keeps = groups.select("h", "keep_id", "keep_t", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    m = members.select(F.col("doc_id").alias("m_id"), F.col("t").alias("m_t"), "h", "sha", "share").distinct()
    k = keeps.select(F.col("keep_id").alias("k_id"), F.col("keep_t").alias("k_t"), F.col("h").alias("k_h"), F.col("share").alias("k_share"))

    def text_of(narrow: DataFrame, row_id: str, t: str) -> DataFrame:
        here = texts.select(F.col("doc_id").alias("t_id"), F.xxhash64("text").alias("t_t"), "text")
        return here.join(narrow, F.col("t_id").eqNullSafe(F.col(row_id)) & (F.col("t_t") == F.col(t)))
    kept = text_of(k, "k_id", "k_t").select("k_h", "k_share", norm.alias("kept_text")).dropDuplicates(["k_h", "k_share"])
    own = text_of(m, "m_id", "m_t").select(
        F.col("m_id").alias("bad_id"), F.col("h").alias("bad_h"), F.col("sha").alias("bad_sha"), "share", norm.alias("other"))
    pairs = own.join(kept, (F.col("bad_h") == F.col("k_h")) & (F.col("share") == F.col("k_share")))
    return (pairs.where(F.col("other") != F.col("kept_text")).select("bad_id", "bad_h", "bad_sha", "other")
            .dropDuplicates(["bad_id", "bad_h", "bad_sha", "other"]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that exact dedup keeps;
    of repeated rows one."""
    tag = f"_{uuid.uuid4().hex[:8]}"
    found = exact_groups(docs, id_col, text_col).where("kept")
    # How often a kept row is repeated.
    keys = found.groupBy("doc_id", "group_hash").agg(F.count("*").alias(f"{tag}_n"), F.max("n_points").alias(f"{tag}_p"))
    keys = keys.withColumnsRenamed({"doc_id": f"{tag}_id", "group_hash": f"{tag}_h"})
    here = docs.withColumns({f"{tag}_c": F.md5(normalised(F.col(text_col)).cast("binary")),
                             f"{tag}_q": F.length(F.coalesce(F.col(text_col), F.lit("")))})
    rows = here.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col(f"{tag}_id"))
                     & (F.col(f"{tag}_c") == F.col(f"{tag}_h")) & (F.col(f"{tag}_q") == F.col(f"{tag}_p")))
    one = Window.partitionBy(F.col(f"{tag}_id"), F.col(f"{tag}_h")).orderBy(F.lit(1))
    repeats = (rows.where(F.col(f"{tag}_n") > 1).withColumn(f"{tag}_r", F.row_number().over(one))
               .where(F.col(f"{tag}_r") == 1))
    return rows.where(F.col(f"{tag}_n") == 1).select(docs.columns).unionAll(repeats.select(docs.columns))
