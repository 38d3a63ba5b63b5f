import random

import pytest

from cartwheel.llm import line_dedup
from cartwheel.llm.queries import op13_line_dedup
from cartwheel.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars, min_docs):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    keep = {k: max(d for d in docs if d is not None) for k, docs in holders.items() if len(docs) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [n for n, line in enumerate(lines) if key(line) in keep and keep[key(line)] != doc_id]
        out.append((str(doc_id), len(lines), gone, "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    return sorted(out)


def found(frame):
    return sorted((str(r.doc_id), r.n_lines, list(r.dropped), r.kept) for r in frame.collect())


ODD = [(None, "same line of text\nother"), (None, "same line of text"), (9, None), (9, "same line of text"), (8, ""),
       (7, " \tSAME line OF text\r\n\n"), (6, "Ämter und Ähnliches\nsame line of text\nsame line of text"), (5, "Same Line Of Text"),
       (4, "Ämter und Ähnliches"), (3, "Ämter UND Ähnliches"), (2, "ämter und Ähnliches"), (2, "ämter und Ähnliches"), (1, "x\ny")]


@pytest.mark.parametrize("batches,fan", [(1, 2), (3, 2), (5, 3)])
def test_odd_rows_equal_brute_force(spark, batches, fan):
    docs = spark.createDataFrame([(i, t, 1, "h") for i, t in ODD], "doc_id long, text string, t int, h string")
    done = line_dedup.remove_repeated_lines(docs, min_chars=10, min_docs=3, batches=batches, fan=fan)
    assert found(done) == brute(ODD, 10, 3)


def test_random_lines_and_a_hot_one(spark):
    rng = random.Random(5)
    pool = [f"line number {k} of the pool, long enough for a key" for k in range(60)] + ["short"] * 5 + [""]
    rows = [(k, "\n".join((["A third of all documents hold this line here."] if k % 3 == 0 else [])
                          + rng.choices(pool, k=rng.randrange(8)))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(line_dedup.remove_repeated_lines(docs)) == brute(rows, 40, 5)


def test_very_long_text(spark):
    line = "the same forty characters again and again, and on"
    rows = [(k, "\n".join([line] * 5000 if k == 1 else [line, f"tail {k}"])) for k in range(1, 8)]
    assert found(line_dedup.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 40, 5)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.remove_repeated_lines(docs).collect() == []


def test_runs_merge_by_level_and_join_without_a_shuffle(spark):
    runs = line_dedup.Runs(spark, fan=2)
    for k in range(5):
        run = runs.table(spark.range(k * 10, k * 10 + 20).selectExpr("cast(cast(id as string) as binary) as h", "1L as n"), "run")
        if k == 3:
            fresh = runs.unseen(spark.table(run[0]))
            plan = fresh._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert sorted(int(r.h) for r in fresh.collect()) == list(range(40, 50))
        runs.add(run)
    assert [len(level) for level in runs.levels] == [1, 0, 1] and runs.merges == 3
    assert sum(r.n for r in runs.counts().collect()) == 100
    names = [name for name, _ in runs.all()]
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_no_python_in_the_plan(spark, sf):
    plan = op13_line_dedup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_matches_sql(spark, sf):
    r = compare(spark, duck(sf), "op13_line_dedup", op13_line_dedup, ORACLE["op13_line_dedup"], sf)
    assert r["status"] == "match", r
