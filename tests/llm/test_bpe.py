import hashlib
import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import bpe, token_store
from cartwheel.llm.queries import op1_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "Hello<|endoftext|>World <|startoftext|> x", "<|ENDOFTEXT|>", "it's don't 'S we'LL ab'c",
       "ΣΑΣ ΟΔΥΣΣΕΥΣ", "İstanbul éa Å ́ x", "a\x1cb\x1d c\x85d\xa0e　f", "日本語テキスト😀😀 ½ ² Ⅷ",
       "x" * 1000 + " " + "ab" * 5000, "..." * 2000, "'re're 's", "ﬁ ſ K", "123 4.5"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(library):
    own, rnd = bpe.WordBpe(PATH), random.Random(1)
    letters = "abcdeÉèΣσς'’.,!?  \n\t12³é́̈<|>endoftxsra"
    texts = ODD + ["".join(rnd.choices(letters, k=rnd.randint(0, 80))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:60]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def assigned():
    return [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]


def check_all(library, encoders, texts):
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    for encoder in encoders:
        for at in range(0, len(texts), 2000):
            got = encoder.encode(texts[at:at + 2000])
            bad = [(texts[at + k], g) for k, g in enumerate(got) if g != want[at + k]]
            assert not bad, [ascii(t) for t, _ in bad[:5]]


def test_every_code_point_between_letters(library):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b" for c in points[at:at + 40]) for at in range(0, len(points), 40)]
    alone = [c for c in points if bpe.TextPieces.VERIFIED.fullmatch(c)]
    texts += [f(c) for c in alone for f in (str, lambda c: c + "a", lambda c: "a" + c, lambda c: c + c, lambda c: "a." + c, lambda c: "1" + c + "Σ")]
    check_all(library, [bpe.WordBpe(PATH), token_store.LibraryEncoder(PATH)], texts)


def test_marks_after_letters_and_random_assigned_characters(library):
    points, rnd = assigned(), random.Random(3)
    marks = [c for c in points if unicodedata.category(c).startswith("M")]
    texts = [b + m for m in marks for b in "aEé가अ"] + [" ".join(a + b for a, b in zip(marks[k::7], marks[k + 1::7])) for k in range(7)]
    texts += ["".join(rnd.choices(points, k=rnd.randint(1, 5))) for _ in range(40_000)]
    texts += ["".join(rnd.choices(marks, k=3)) + rnd.choice(points) + rnd.choice(marks) for _ in range(10_000)]
    check_all(library, [bpe.WordBpe(PATH), token_store.LibraryEncoder(PATH)], texts)


def test_rank_array_and_heap_merge_alike():
    own, rnd = bpe.WordBpe(PATH), random.Random(2)
    words = [bytes(rnd.choices(b"etaoinshr", k=rnd.randint(1, 90))) for _ in range(500)]
    assert own._short_words(words) == [own._long_word(w) for w in words]


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    own = bpe.WordBpe(PATH)
    whole = bpe.WordBpe(PATH).encode([f"word{k} a{k}." for k in range(50)])
    assert [own.encode([f"word{k} a{k}."])[0] for k in range(50)] == whole
    assert len(own.cut.known) <= 14


def test_query_equals_the_library(spark, library, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in op1_bpe(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_empty_repeats_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "y", 2), (3, "the the", None, 3), (3, "the the", None, 3),
                                  (None, "the", "z", 4)], "doc_id long, text string, ids string, n_tokens int")
    rows = bpe.encode_decode(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in rows) == [
        (0, 1, "the</w>"), (1, 0, ""), (2, 0, ""), (3, 2, "the</w> the</w>"), (3, 2, "the</w> the</w>")]
    again = bpe.decode(bpe.encode_decode(docs, PATH, decode=False), PATH).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in rows)
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0
