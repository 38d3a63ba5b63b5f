import zlib

import pytest

from cartwheel.llm import langid
from cartwheel.llm.queries import op4_language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_language(spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_logits_equal_the_averaged_embeddings(model):
    texts = ["the quick thing", "x", "ñandú y el niño", "a" * 50]
    for t, got in zip(texts, model.logits(texts)):
        grams = langid.gram_lists([t])[0]
        want = sum(model.table[g].astype(float) for g in grams) / max(1, len(grams)) + model.bias
        assert got == pytest.approx(want, abs=1e-5)


def test_long_text_is_read_whole_in_windows(model, monkeypatch):
    text = "le monde que nous " * 500 + "the world that " * 700
    whole = model.logits([text, "le", text])
    monkeypatch.setattr(langid, "WINDOW", 1000)
    assert model.logits([text, "le", text]) == pytest.approx(whole)


def test_rejection_keeps_known_languages(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = langid.drop_rejected(docs, model)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in langid.predict(docs, model).where("rejected").collect()}
    assert kept.count() == docs.count() - len(gone)
    assert len(gone) <= 0.01 * docs.count()
    assert not {r.doc_id for r in kept.collect()} & gone


def test_null_empty_letterless_repeats_and_clashing_columns(spark, model):
    rows = [(1, None, "en", 0), (2, "", None, 0), (3, "123 -- !!", "en", 0), (4, "los que con", None, 0),
            (4, "los que con", None, 0), (None, "the and", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = sorted((r.doc_id or 0, r.lang_pred, r.score > 0) for r in langid.predict(docs, model).collect())
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und", False), (2, "und", False), (3, "und", False)]
    assert [g[1] for g in got if g[0] == 4] == ["es", "es"]
    assert langid.drop_rejected(docs, model).columns == docs.columns
    assert langid.predict(docs.limit(0), model).count() == 0


def test_no_labelled_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    none = langid.fit(docs)
    assert [r.lang_pred for r in langid.predict(docs, none).collect()] == ["und", "und"]


FOREIGN = ["A magyar nyelv az uráli nyelvcsalád tagja, a finnugor nyelvek közé tartozó ugor nyelvek egyike.",
           "Język polski należy do grupy zachodniosłowiańskiej rodziny języków indoeuropejskich.",
           "Η ελληνική γλώσσα ανήκει στην ινδοευρωπαϊκή οικογένεια γλωσσών.", "日本語は主に日本で使われている言語である。",
           "Русский язык является одним из восточнославянских языков.", "qwxz zzkp vvbn qqqq", "aaaa bbbb cccc",
           "Suomen kieli kuuluu uralilaisten kielten itämerensuomalaiseen ryhmään"]


def test_unlike_texts_are_rejected_and_clean_ones_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    assert sum(model.predict(FOREIGN)[2]) >= 7
    lettered = [r.text for r in docs.collect() if r.text and any(map(str.isalpha, r.text))]
    assert sum(model.predict(lettered)[2]) <= 0.01 * len(lettered)
    assert not model.predict(["a", "the"])[2][0]            # no n-gram: nothing to judge by


def test_nothing_learned_keeps_what_has_letters(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "123", None), (3, None, None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert [r.doc_id for r in langid.drop_rejected(docs, model).collect()] == [1]


def test_repeated_ids_are_learned_from_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS_PER_LANG", 20)
    seen = []
    monkeypatch.setattr(langid, "train", lambda snippets: seen.append(snippets))
    rows = [(7, f"word number {k} of the same id", "en") for k in range(500)] + [(k, f"mot numéro {k}", "fr") for k in range(40)]
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    per = {lang: sum(x[1] == lang for x in seen[0]) for lang in ("en", "fr")}
    assert per["en"] <= langid.SNIPPETS_PER_ROW and 0 < per["fr"] <= 20 * langid.SNIPPETS_PER_ROW


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    rows = [(k, "text", f"l{k % 3}") for k in range(60)]
    with pytest.raises(ValueError, match="languages"):
        langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
