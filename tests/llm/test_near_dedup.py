import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import near_dedup as nd
from cartwheel.llm.queries import op6_near_dedup


def bag(text):
    words = text.lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def similarity(a, b):
    both = a | b
    return sum((a & b).values()) / sum(both.values()) if both else 0.0


def brute(texts):
    """Smallest row number of each row's class, all pairs compared."""
    bags, root = [bag(t or "") for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def edited(rnd, words, n, vocabulary):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = rnd.choice(vocabulary)
    return out


def corpus(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = []
    for size in (4, 7, 30, 60, 200, 400):
        for _ in range(4):
            base = rnd.choices(vocabulary, k=size)
            texts.append(" ".join(base))
            for edits in (0, 1, 2, 3, 5):
                texts.append(" ".join(edited(rnd, base, edits * size // 100 + (edits == 1), vocabulary)))
            texts.append(" ".join(base + base[:size // 4]))
    line = rnd.choices(vocabulary, k=12)
    texts += [" ".join(line * k) for k in (1, 2, 3, 10, 11, 12, 13)]
    texts += [" ".join(line + rnd.choices(vocabulary, k=20)) for _ in range(30)]
    rnd.shuffle(texts)
    return texts


def test_signatures_are_unbiased():
    rnd = random.Random(1)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = rnd.choices(vocabulary, k=300)
    for edits in (0, 5, 30):
        a, b = " ".join(base + base[:50] * 6), " ".join(edited(rnd, base, edits, vocabulary) + base[:50] * 4)
        signs = nd.signatures(*nd.multisets([a, b]), 2, 4000)
        assert (signs[0] == signs[1]).mean() == pytest.approx(similarity(bag(a), bag(b)), abs=0.03)


def test_overlap_is_the_weighted_jaccard():
    texts = corpus()
    sets = nd._members(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])).column(1).to_pylist()
    for i in range(0, len(texts) - 1, 3):
        for j in (i + 1, (i * 7) % len(texts)):
            assert nd.overlap(sets[i], sets[j]) == pytest.approx(similarity(bag(texts[i]), bag(texts[j])))


def test_signature_is_the_same_in_any_batch():
    texts = corpus()[:40]
    alone = np.concatenate([nd.signatures(*nd.multisets([t]), 1) for t in texts])
    assert (nd.signatures(*nd.multisets(texts), len(texts)) == alone).all()


def test_classes_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.classes(docs).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts)


def test_query_equals_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op6_near_dedup(spark, sf).collect()}
    want = [docs[k].doc_id for k in brute([d.text for d in docs])]
    assert [got[d.doc_id].class_id for d in docs] == want
    sizes = Counter(want)
    assert all(got[d.doc_id].class_size == sizes[w] and got[d.doc_id].kept == (d.doc_id == w) for d, w in zip(docs, want))


def test_components_join_long_chains(spark):
    chain = [(bytes([k]), bytes([k + 1])) for k in range(40)] + [(b"x1", b"x2")]
    random.Random(2).shuffle(chain)
    links = spark.createDataFrame(chain, "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in nd.components(links, nd.Scratch(spark)).collect()}
    assert got == {bytes([k]): b"\0" for k in range(41)} | {b"x1": b"x1", b"x2": b"x1"}


def test_nulls_repeats_ties_and_extra_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "one two", "c"), (4, "ONE  two", "d"), (5, text, "e"),
            (5, text, "e"), (None, text, "f"), (None, "lone words here", "g"), (6, text + " more", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in nd.classes(docs).collect())
    assert got == [("1", "1", 1), ("2", "2", 1), ("2", "2", 1), ("3", "3", 2), ("4", "3", 2), ("5", "5", 4), ("5", "5", 4),
                   ("6", "5", 4), ("None", "5", 4), ("None", "None", 1)]
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.node) for r in kept.collect()) == [
        ("1", "a"), ("2", "b"), ("2", "b"), ("3", "c"), ("5", "e"), ("None", "g")]
    assert nd.classes(docs.limit(0)).count() == 0 and nd.keep_one(docs.limit(0)).count() == 0
