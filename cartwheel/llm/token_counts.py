"""Operator 7: token counts through a digest cache.

The cache is a table of (content digest, tokenizer digest) -> count. Counting
joins the digests of the texts, normalised by taking null for empty (any other
change could change a count), and of the tokenizer's file to the stored
counts; one document of each distinct missing text is encoded and its count is
appended to the cache. A second call, or a corpus with copies, encodes nothing
twice.

Texts are moved only to pick those representatives: the distinct misses are
found from digests and document ids alone.

Defined results: null and empty texts have 0 tokens; repeated rows are all
counted, from one encoding; rows with a null id are counted too; an empty table
adds nothing; other columns are ignored. The cache may hold a key twice after
concurrent calls; its counts are then equal and one is taken.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cartwheel.llm.common import id_and_text, map_slices

#: Distinct pieces a Python worker remembers, and the longest of them.
CACHE_ENTRIES = 500_000
LONGEST_PIECE = 64

CACHE_SCHEMA = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("tokenizer", T.StringType()),
                             T.StructField("n_tokens", T.LongType())])


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceCounter:
    """Counts tokens of whole texts by the tokenizers library.

    The byte-level pattern takes white space with what follows it and never
    looks back, so a text may be cut before each run of white space; the
    library encodes each distinct piece once per Python worker. A text with
    white space other than blanks and line ends is encoded in one go."""

    PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    OTHER_SPACE = re.compile(r"[^\S \n]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        pre = self.library.pre_tokenizer
        self.cuts = self.library.normalizer is None and type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space
        self.known: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        out, held, missing = [-1] * len(texts), [], set()
        for k, text in enumerate(texts):
            if not self.cuts or self.OTHER_SPACE.search(text):
                out[k] = self.lengths([text])[0]
                continue
            pieces = self.PIECE.findall(text)
            counts = list(map(self.known.get, pieces))
            if None in counts:
                missing.update([p for p, c in zip(pieces, counts) if c is None])
                held.append((k, pieces, counts))
            else:
                out[k] = sum(counts)
        new = list(missing)
        found = dict(zip(new, self.lengths(new)))
        for k, pieces, counts in held:
            out[k] = sum([found[p] if c is None else c for p, c in zip(pieces, counts)])
        self.known.update({p: c for p, c in found.items() if len(p) <= LONGEST_PIECE})
        return out


@lru_cache(2)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; none where nothing has been appended yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder)


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, n_bytes (UTF-8) and n_tokens of each row. ``path`` is the
    tokenizer's file on every executor, ``cache`` the cache's shared folder."""
    spark, version = docs.sparkSession, tokenizer_digest(path)
    rows = id_and_text(docs, id_col, text_col)
    digests = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"),
                          F.octet_length("text").cast("long").alias("n_bytes"))
    stored = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest")
    missing = (digests.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
               .join(stored, "digest", "left_anti"))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = piece_counter(path).count(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    # The representative's row: equal ids and digests, of repeated rows any one.
    # Rows meet by id; the wide side is spread by it and never sorted.
    wide = rows.withColumnRenamed("doc_id", "row_id").withColumn("row_digest", F.unhex(F.sha2("text", 256)))
    meet = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_digest") == F.col("digest"))
    misses = wide.join(missing.hint("shuffle_hash"), meet).select("digest", "text")
    (map_slices(misses, encode, "digest binary, n_tokens long").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
     .select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache))
    counts = (read_cache(spark, cache).where(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return digests.join(counts, "digest").select("doc_id", "digest", "n_bytes", "n_tokens")
