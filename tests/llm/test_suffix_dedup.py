import hashlib
import random

import numpy as np
import pytest

from cartwheel.llm import suffix_dedup as sd
from cartwheel.llm.queries import op3_passages

L = sd.LENGTH


def brute(rows):
    """(n_bytes, spans, kept) by row number; rows are (doc_id, text), taken in
    the order of ids, nulls last."""
    seen, out = set(), {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        raw = (rows[k][1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - L + 1):
            if raw[p:p + L] in seen:
                gone[p:p + L] = True
            seen.add(raw[p:p + L])
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        out[k] = (len(raw), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


def of(frame):
    return sorted((str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in frame.collect())


def wanted(rows):
    return sorted((str(rows[k][0]), *v) for k, v in brute(rows).items())


def corpus(seed=3):
    rnd = random.Random(seed)
    words = ["the", "of", "été", "river", "stone", "ñandú", "a", "wind", "quiet", "日本"]
    text = lambda n: " ".join(rnd.choices(words, k=n))                      # noqa: E731
    passages = [text(40) for _ in range(4)]
    line = "a line that comes in every text, some 60 bytes of it.\n"
    rows = []
    for k in range(60):
        parts = [text(rnd.randint(0, 30)) for _ in range(3)]
        parts.insert(rnd.randint(0, 2), rnd.choice(passages)[rnd.randint(0, 40):])
        rows.append((k, line.join(parts)))
    rows += [(100, rows[7][1]), (101, rows[7][1] + "!"), (102, "x" * 700), (103, "ab" * 300 + "x" * 150), (104, "x" * 99),
             (105, passages[0][:101]), (106, text(400) * 2)]
    rnd.shuffle(rows)
    return rows


def test_interval_expansion_finds_all_repeats():
    rnd = np.random.default_rng(1)
    for length, letters in ((1, 3), (3, 2), (5, 3), (8, 2), (4, 26)):
        for _ in range(20):
            text = rnd.integers(0, letters + 1, int(rnd.integers(1, 120)))
            text[-1] = 0
            want = {}
            for p in range(len(text) - length + 1):
                s = tuple(text[p:p + length].tolist())
                if 0 not in s:
                    want.setdefault(s, set()).add(p)
            at, group = sd.common_prefix_groups(text, length)
            got = {}
            for p, g in zip(at.tolist(), group.tolist()):
                got.setdefault(g, set()).add(p)
            assert sorted(map(sorted, got.values())) == sorted(sorted(w) for w in want.values() if len(w) > 1)


def test_equal_windows_have_equal_fingerprints_and_places(monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 128)
    by_window = {}
    for _, text in corpus():
        raw = text.encode()
        seen = 0
        for fp, _, start, n in zip(*(c.tolist() for c in sd.occurrences(raw))):
            for p in range(start, start + n):
                assert by_window.setdefault(raw[p:p + L], fp) == fp
                seen += 1
        assert seen == max(0, len(raw) - L + 1)


def test_spans_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(3)
    assert of(sd.remove_repeats(docs)) == wanted(rows)


def test_wide_fingerprints_are_refined(spark, monkeypatch):
    monkeypatch.setattr(sd, "MAX_CONTEXTS", 3)
    monkeypatch.setattr(sd, "BLOCK_BYTES", 500)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert of(sd.remove_repeats(docs)) == wanted(rows)


def test_parts_of_a_context_cover_its_windows_alike():
    raw = corpus()[0][1].encode()
    parts = {}
    for _, text in corpus():
        raw = text.encode()
        for _, _, start, n in zip(*(c.tolist() for c in sd.occurrences(raw))):
            piece = raw[start:start + n + L - 1]
            for depth in (1, 3, 7):
                cover = []
                for fp, _, a, m in sd.refined(piece, depth):
                    cover += range(a, a + m)
                    for p in range(a, a + m):
                        assert parts.setdefault((depth, piece[p:p + L]), fp) == fp
                assert cover == list(range(n))


def test_query_equals_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op3_passages(spark, sf).collect()}
    assert len(got) == len(docs)
    for k, (n, spans, kept) in brute([tuple(d) for d in docs]).items():
        r = got[docs[k].doc_id]
        assert (r.n_bytes, r.n_spans, r.n_removed) == (n, len(spans), n - len(kept))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_nulls_repeats_and_empty_table(spark):
    long = "some words that go on " * 9
    rows = [(1, None), (2, ""), (3, long), (4, "tiny"), (4, "tiny"), (5, "y" + long), (5, "y" + long), (None, long + "z")]
    docs = spark.createDataFrame([(*r, [0]) for r in rows], "doc_id long, text string, spans array<int>")
    assert of(sd.remove_repeats(docs)) == wanted(rows)
    assert sd.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("ranges, spans", [([], []), ([(5, 1), (0, 2)], [(0, 105)]), ([(0, 1), (101, 1)], [(0, 100), (101, 201)]),
                                           ([(0, 1), (100, 1)], [(0, 200)])])
def test_ranges_merge_to_maximal_spans(ranges, spans):
    assert sd.merged(ranges) == spans


def test_suffixes_are_ordered_in_few_sorts(monkeypatch):
    """Keys start with as many symbols as they hold (r03: op3_passages); order and neighbours are those of plain sorting."""
    rng = np.random.default_rng(5)
    text = rng.integers(1, 4, 3000)
    text[1000:1300] = text[2000:2300]
    text[[999, 1999, 2999]] = 0
    text[5] = 256
    sorts, real = [], np.argsort
    monkeypatch.setattr(sd.np, "argsort", lambda *a, **k: sorts.append(1) or real(*a, **k))
    order, place = sd.suffix_order(text, L + 1)
    monkeypatch.undo()
    assert len(sorts) <= 5
    cut = [tuple(text[k:k + L + 1]) for k in order]
    assert cut == sorted(cut) and (place[order] == np.arange(len(text))).all()
    at, group = sd.common_prefix_groups(text, L)
    strings = {}
    for k in range(len(text) - L + 1):
        if 0 not in text[k:k + L]:
            strings.setdefault(tuple(text[k:k + L]), []).append(k)
    want = sorted(v for v in strings.values() if len(v) > 1)
    assert sorted(sorted(at[group == g].tolist()) for g in np.unique(group)) == want and len(want) == 201


def test_intervals_start_where_the_sort_left_them(monkeypatch):
    """Only the last symbols are searched (r03: op3_passages); the groups are those of all windows."""
    rng = np.random.default_rng(8)
    text = rng.integers(1, 3, 4000)
    text[1000:1300] = text[2000:2300]
    text[1700:1890] = text[2050:2240]
    text[[999, 1500, 1699, 2999, 3500]] = 0
    text[7] = 256
    steps, real = [], np.repeat
    monkeypatch.setattr(sd.np, "repeat", lambda *a, **k: steps.append(1) or real(*a, **k))
    at, group = sd.common_prefix_groups(text, L)
    monkeypatch.undo()
    assert len(steps) <= 3 * (L - 56) + 1                       # three calls a step; it took a step a symbol
    strings = {}
    for k in range(len(text) - L + 1):
        if 0 not in text[k:k + L]:
            strings.setdefault(tuple(text[k:k + L]), []).append(k)
    want = sorted(v for v in strings.values() if len(v) > 1)
    assert sorted(sorted(at[group == g].tolist()) for g in np.unique(group)) == want and max(map(len, want)) == 3
