import hashlib
import re

from pyspark.sql import functions as F

from cartwheel.llm import exact_dedup
from cartwheel.llm.queries import op8_exact_dedup
from cartwheel.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

ROWS = [(5, "a b"), (3, "ab"), (9, " ab "), (4, None), (2, "  "), (7, "unlike"), (8, "un like"), (None, "alone"),
        (None, "ab"), (1, "a b"), (6, "rep"), (6, "rep"), (6, "rep")]


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(str(i), str(keep[0]), len(members), (i, t) == keep or (i == keep[0] and len(t) == len(keep[1])),
                 hashlib.sha256(norm.encode()).hexdigest()) for i, t in members]
    return sorted(out)


def rows_of(frame):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in frame.collect())


def test_groups_equal_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, h int")
    assert rows_of(exact_dedup.exact_groups(docs)) == brute(ROWS)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARE_ROWS", 2)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    few = lambda text: F.substring(F.md5(text), 1, 0)                       # noqa: E731  every hash is ''
    assert rows_of(exact_dedup.exact_groups(docs, content_hash=few)) == brute(ROWS)


def test_keep_one_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(*r, f"x{k}") for k, r in enumerate(ROWS)], "doc_id long, text string, kept string")
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("1", "a b"), ("2", "  "), ("6", "rep"), ("8", "un like"), ("9", " ab "), ("None", "alone")]


def test_query_matches_sql(spark, sf):
    r = compare(spark, duck(sf), "op8_exact_dedup", op8_exact_dedup, ORACLE["op8_exact_dedup"], sf)
    assert r["status"] == "match", r


def test_repeats_and_null_ids_of_one_length_meet_their_own_texts_alone(spark, monkeypatch):
    """2,000 equal rows of one id, 2,000 null ids with texts of one length, twice each."""
    rows = [(1, "same text")] * 2000 + [(None, f"{k:09d}") for k in range(1000)] * 2 + [(5, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    real = exact_dedup._collisions

    def counted(texts, found, groups, norm):
        m = found.join(groups, "h").select("doc_id", "t", "h").distinct()
        here = texts.select(F.col("doc_id").alias("i"), F.xxhash64("text").alias("x"))
        seen.append(here.join(m, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("x") == F.col("t"))).count())
        return real(texts, found, groups, norm)
    monkeypatch.setattr(exact_dedup, "_collisions", counted)
    got = rows_of(exact_dedup.exact_groups(docs))
    assert seen == [4000]
    assert got == brute(rows)


def test_very_long_text(spark):
    rows = [(1, "x y" * 300_000), (2, "xy" * 300_000), (3, "short")]
    assert rows_of(exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
