import corpus_pipeline as cp
from cartwheel.llm import langid
from cartwheel.llm.common import Scratch, table


def test_stages_take_effect(spark, sf):
    docs, scratch = table(spark, sf, "documents"), Scratch(spark)
    columns, ids = docs.columns, None
    for k, (name, stage) in enumerate(cp.STAGES):
        before = [r.doc_id for r in docs.select("doc_id").collect()]
        docs = scratch.write(stage(spark, docs, sf), f"test-{name}")
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(after) <= set(before) and after
        if k < len(cp.STAGES) - 1:
            assert docs.columns == columns
        if name in ("exact_dedup", "near_dedup"):
            assert len(after) < len(before) and len(set(after)) == len(after)
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_run_and_empty_and_odd_tables(spark, sf, tmp_path):
    assert cp.run(spark, sf).count() > 0
    real = table(spark, sf, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, "", "en", None, 0),
                                 (900_002, "12 34", None, "s", 5), (900_002, "12 34", None, "s", 5),
                                 (900_003, "the and of with", "en", "s", 15), (900_003, "the and of with", "en", "s", 15)],
                                real.schema)
    for name, frame in (("empty", real.limit(0)), ("odd", real.unionAll(odd))):
        folder = f"{tmp_path}/{name}"
        frame.write.parquet(f"{folder}/documents.parquet")
        out = [r.doc_id for r in cp.run(spark, folder).collect()]
        assert (name == "empty") == (not out)
        assert not {None, 900_001, 900_002} & set(out)


def test_rejection_spares_clean_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = langid.drop_rejected(docs, langid.fit(docs)).count()
    assert kept >= 0.99 * docs.count()
