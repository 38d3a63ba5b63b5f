import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import token_store
from cartwheel.llm.queries import op2_token_store
from cartwheel.llm.token_store import EliasFano
from cartwheel.session import scratch_path
from tests.llm.test_bpe import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (5, 3), (1000, 100_000), (3000, 40), (10_000, 10 ** 9)])
def test_elias_fano_select(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n))
    made = EliasFano.of(values)
    read = EliasFano(made.n, made.low_bits, made.low, made.high)
    assert (read.values(np.arange(n)) == values).all()
    if n >= 1000:
        assert (len(made.low) + len(made.high)) * 8 <= n * (2.1 + max(0, np.log2(top / n)))


def expected(rows):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op2_token_store(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == expected([tuple(d) for d in docs])


def test_small_blocks_odd_texts_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 50)
    rows = [(k, t) for k, t in enumerate([*ODD, None])] + [(100, "again and again")] * 3
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, part int").repartition(3)
    folder = scratch_path(spark, "test-store")
    token_store.write(docs, folder, PATH, 1)
    got = token_store.with_start(token_store.documents(spark, folder), folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got) == expected(rows)


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (3, "b")], "doc_id long, text string")
    for frame, n in ((docs.limit(0), 0), (docs, 3)):
        folder = scratch_path(spark, "test-store")
        token_store.write(frame, folder, PATH, 1)
        got = token_store.with_start(token_store.documents(spark, folder), folder).collect()
        assert len(got) == n
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 3]
