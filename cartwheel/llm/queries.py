"""The registered queries of this subpackage: each applies its operator to a
whole table with production parameters and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (ann, bpe, exact_dedup, hard_negatives, langid, line_dedup, manifest, mixing, near_dedup,
                           suffix_dedup, token_counts, token_store, warc)
from cartwheel.llm.common import table
from cartwheel.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
#: Id that ends a document in the token store.
END_ID = 1
#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 512
#: The pages whose copies the audited replica holds damaged: page_id % step = rest.
DAMAGE_STEP, DAMAGE_REST = 97, 13


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document, and the text they decode to, as digests."""
    done = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to block files and read back from them."""
    folder = scratch_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE), END_ID)
    rows = token_store.documents(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return token_store.with_start(rows, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing repeated passages leaves of every document."""
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes, and the shards its
    copies are dealt to."""
    taken = (F.col("size") * F.size("shards")).alias("taken")
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken, "shards")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and which of it stays."""
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through a cache that starts empty."""
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                       scratch_path(spark, "token-counts"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of every group of equal texts stays."""
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found of every 50th vector, among all others."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: F.pmod(vec_id, F.lit(50)) == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of all pages against the archive. The replica's copies
    of every 97th page are damaged in place: '<' has become '{'."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    hit = F.pmod("page_id", F.lit(DAMAGE_STEP)) == DAMAGE_REST
    copies = pages.withColumn("html", F.when(hit, F.translate("html", "<", "{")).otherwise(F.col("html")))
    primary, replica = scratch_path(spark, "warc-primary"), scratch_path(spark, "warc-replica")
    warc.write_archive(pages, primary)
    warc.write_archive(copies, replica)
    return warc.audit(spark, primary, replica).select("page_id", "n_bytes", "payload_sha256", "status")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector's positives; every 7th label is off by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    off = F.pmod("vec_id", F.lit(7)) == 0
    rows = rows.withColumn("label", F.when(off, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label")))
    return hard_negatives.mine(rows, lambda vec_id: F.pmod(vec_id, F.lit(50)) == 0)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and whether a document that has
    been put in lower case, one of five, still folds to the root."""
    docs = table(spark, sf_dir, "documents")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lowered = F.translate("text", line_dedup.UPPER, line_dedup.LOWER)
    fields = [F.col(c) for c in manifest.HASHED[:-1]]
    found = manifest.manifest(docs, carry={"tampered": F.when(hit, manifest.leaf_hash(*fields, lowered))})
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", manifest.proof_hash(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What dropping repeated lines leaves of every document."""
    done = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                       F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_token_store": op2_token_store,
    "op3_passages": op3_passages,
    "op4_language": op4_language,
    "op5_mixing": op5_mixing,
    "op6_near_dedup": op6_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_nearest": op9_nearest,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_manifest": op12_manifest,
    "op13_line_dedup": op13_line_dedup,
}
