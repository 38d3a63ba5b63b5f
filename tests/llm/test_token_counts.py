import random

import public_tokenizers
from tokenizers import Tokenizer

from cartwheel.llm import token_counts
from cartwheel.llm.queries import op7_token_counts
from cartwheel.session import scratch_path
from tests.llm.test_bpe import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_piecewise_counts_equal_the_library():
    library, own, rnd = Tokenizer.from_file(PATH), token_counts.PieceCounter(PATH), random.Random(3)
    letters = "aé'’s.  \n\n\t12<|endoftext|> "
    texts = ODD + ["a <|endoftext|> b", " \n<|endoftext|> \n x", "  a  b \n c\n"]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(2000)]
    assert own.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_query_equals_the_library(spark, sf):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in op7_token_counts(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        r = got[d.doc_id]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((d.text or "").encode()), n > 512)


def test_only_distinct_misses_are_encoded(spark):
    docs = spark.createDataFrame([(1, "one two", 0), (2, "one two", 0), (2, "one two", 0), (None, "x", 0), (4, None, 0),
                                  (5, "", 0)], "doc_id long, text string, digest int")
    cache = scratch_path(spark, "test-counts")
    first = token_counts.count_tokens(docs, PATH, cache)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in first.collect()) == [(0, 1), (1, 2), (2, 2), (2, 2), (4, 0), (5, 0)]
    assert token_counts.read_cache(spark, cache).count() == 3
    more = docs.unionAll(spark.createDataFrame([(6, "a new text", 0)], docs.schema))
    second = token_counts.count_tokens(more, PATH, cache)
    assert second.count() == 7
    assert token_counts.read_cache(spark, cache).count() == 4
    token_counts.count_tokens(more, PATH, cache)
    assert token_counts.read_cache(spark, cache).count() == 4
    assert token_counts.count_tokens(docs.limit(0), PATH, cache).count() == 0


def test_stored_counts_are_used(spark):
    cache = scratch_path(spark, "test-counts")
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    token_counts.count_tokens(docs, PATH, cache)
    wrong = token_counts.read_cache(spark, cache).withColumn("n_tokens", token_counts.F.lit(99).cast("long"))
    other = scratch_path(spark, "test-counts")
    wrong.write.parquet(other)
    assert token_counts.count_tokens(docs, PATH, other).first().n_tokens == 99
