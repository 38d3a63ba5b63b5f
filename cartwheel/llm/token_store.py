"""Operator 2: token ids in a binary file format.

A store is a folder of block files and an index. A block holds the ids of
consecutive documents as one array of little-endian unsigned integers (16 bits
wide where the vocabulary allows, else 32), the documents' boundaries in that
array as an Elias-Fano sequence, and their doc_ids. The index has the number of
ids before each block. Elias-Fano splits each boundary into low bits, packed,
and high bits, written in unary into a bit vector; the offset of document k is
found by a select on that vector, through a directory of set bits per 512-bit
line, in about 2 + log2(ids / documents) bits a document and with no table of
64-bit offsets.

Blocks are cut at ``BLOCK_IDS`` ids, so a writer or reader holds one block,
and are written by Spark's own Parquet writer to any shared file system.

Defined results: null and empty texts hold the end id alone; rows come in
ascending (doc_id, text hash, text) order, null doc_ids first, repeated rows
one after another; an empty table makes an empty store; other columns are
ignored.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm.bpe import TextPieces, byte_letters
from cartwheel.llm.common import SLICE_ROWS, id_and_text

#: A block is closed once it has this many ids.
BLOCK_IDS = 1_000_000
#: Bits of a select directory's line.
LINE_BITS = 512

BLOCK_SCHEMA = ("part int, block int, n_docs long, n_ids long, id_bytes int, ids binary, "
                "low_bits int, low binary, high binary, doc_ids array<long>")


class EliasFano:
    """A non-decreasing sequence of integers below ``2**63``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        line = np.frombuffer(high.ljust(-(-len(high) // 64) * 64, b"\0"), np.uint8).reshape(-1, 64)
        self.lines = line
        ones = np.bitwise_count(line).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones))).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        vector = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        vector[ones] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(vector, bitorder="little").tobytes())

    def select(self, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th set bits (from 0) of the high vector."""
        k = np.asarray(k, np.int64)
        out = np.empty(len(k), np.int64)
        for at in range(0, len(k), 4096):
            part = k[at:at + 4096]
            line = np.searchsorted(self.before, part, "right") - 1
            inside = np.unpackbits(self.lines[line], axis=1, bitorder="little").cumsum(axis=1, dtype=np.int32)
            rest = part - self.before[line]
            out[at:at + 4096] = line * LINE_BITS + (inside <= rest[:, None]).sum(axis=1)
        return out

    def values(self, k: np.ndarray) -> np.ndarray:
        """The k-th values, by select."""
        k = np.asarray(k, np.int64)
        bit = k[:, None] * self.low_bits + np.arange(self.low_bits)
        low = np.frombuffer(self.low, np.uint8)
        bits = (low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 if self.low_bits else np.zeros((len(k), 0), np.int64)
        return (self.select(k) - k << self.low_bits) + (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, each distinct word encoded
    once per Python worker (bounded cache): words of verified letters by the
    library's model, any other piece by the library as a whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library, self.letters = Tokenizer.from_file(path), byte_letters()
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.cut = TextPieces(path, self.words, self.odd)

    def words(self, words: list[str]) -> list[bytes]:
        merge, letters = self.model.tokenize, self.letters
        return [b"".join([t.id.to_bytes(4, "little") for t in merge("".join([letters[b] for b in w.encode()]))])
                for w in words]

    def odd(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.cut.encode(texts)


@lru_cache(2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _block(part: int, block: int, doc_ids: list, ids: list[bytes]) -> pa.RecordBatch:
    flat = np.frombuffer(b"".join(ids), "<u4")
    starts = np.cumsum([0, *(len(x) // 4 for x in ids)])
    width = 2 if not len(flat) or flat.max() < 1 << 16 else 4
    bounds = EliasFano.of(starts)
    values = [part, block, len(doc_ids), len(flat), width, flat.astype(f"<u{width}").tobytes(),
              bounds.low_bits, bounds.low, bounds.high, doc_ids]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
             pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          encoder: Callable[[str], LibraryEncoder] = library_encoder) -> None:
    """Encodes whole texts, ends each with ``end_id`` and writes the store to
    ``folder`` in ascending doc_id order."""
    spark = docs.sparkSession
    order = ["doc_id", "tie", "text"]
    ranged = (id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
              .repartitionByRange("doc_id", "tie").sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    end = end_id.to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, doc_ids, ids, n, part, block = encoder(path).encode, [], [], 0, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                part = rows.column(0)[0].as_py()
                for doc_id, x in zip(rows.column(1).to_pylist(), encode(rows.column(2).to_pylist())):
                    doc_ids.append(doc_id)
                    ids.append(x + end)
                    n += len(x) // 4 + 1
                    if n >= BLOCK_IDS:
                        yield _block(part, block, doc_ids, ids)
                        doc_ids, ids, n, block = [], [], 0, block + 1
        if doc_ids:
            yield _block(part, block, doc_ids, ids)

    # Small row groups: a reading task then holds a few blocks.
    ranged.mapInArrow(blocks, BLOCK_SCHEMA).write.option("parquet.block.size", 16 << 20).parquet(f"{folder}/blocks")
    sizes = spark.read.parquet(f"{folder}/blocks").select("part", "block", "n_ids")
    # Ids before a part: a running sum over one row per part; before a block: within its part.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("ahead"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    index = sizes.withColumn("inside", inside).join(before, "part")
    index.select("part", "block", (F.col("ahead") + F.col("inside")).alias("first_id")).write.parquet(f"{folder}/index")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """part, block, doc_id, at (ids before it in its block), n_tokens and ids
    (binary: little-endian unsigned 32-bit integers) from a store's blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (batch.slice(k, 1).to_pylist()[0] for batch in batches for k in range(batch.num_rows)):
            bounds = EliasFano(b["n_docs"] + 1, b["low_bits"], b["low"], b["high"])
            ids = np.frombuffer(b["ids"], f"<u{b['id_bytes']}")
            for at in range(0, b["n_docs"], SLICE_ROWS):
                to = min(at + SLICE_ROWS, b["n_docs"])
                starts = bounds.values(np.arange(at, to + 1))
                raw = [ids[i:j].astype("<u4").tobytes() for i, j in zip(starts[:-1], starts[1:])]
                columns = [pa.array([b["part"]] * (to - at), pa.int32()), pa.array([b["block"]] * (to - at), pa.int32()),
                           pa.array(b["doc_ids"][at:to], pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)),
                           pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "doc_id", "at", "n_tokens", "ids"])

    return spark.read.parquet(f"{folder}/blocks").mapInArrow(
        run, "part int, block int, doc_id long, at long, n_tokens long, ids binary")


def with_start(rows: DataFrame, folder: str) -> DataFrame:
    """Replaces part, block and at of documents by start, the ids of all
    documents before them."""
    index = rows.sparkSession.read.parquet(f"{folder}/index")
    return (rows.join(index, ["part", "block"]).withColumn("start", F.col("first_id") + F.col("at"))
            .drop("part", "block", "at", "first_id"))
