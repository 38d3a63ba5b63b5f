import hashlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import manifest
from cartwheel.llm.queries import op12_manifest
from cartwheel.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(nodes):
    """The root of a list of digests, and each one's siblings (left, right) by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_no, i in enumerate(at):
            first = i - i % 16
            paths[leaf_no].append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 16])))
        nodes = [H(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, path) of every row."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = {s: (sorted(by_source[s]), *tree([m[2] for m in sorted(by_source[s])])) for s in names}
    root, over = tree([subtrees[s][1] for s in names])
    return sorted((str(m[3]), m[2], subtrees[s][1], root, tuple(p + over[k]))
                  for k, s in enumerate(names) for m, p in zip(subtrees[s][0], subtrees[s][2], strict=True))


def found(frame):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.path)) for r in frame.collect())


def rows_of(sizes):
    out = []
    for s, n in sizes.items():
        out += [(k * 3 - 7, s, "de" if k % 3 else None, k if k % 4 else None, f"Text Ä {k}" if k % 5 else (None, "")[k % 2], k, "x")
                for k in range(n)]
    return out


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_trees_of_all_depths_equal_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    sizes = {None: 3, "": 1, "b": 16, "a": 17, "Ä": 257, "z": 600} | {f"s{k}": 1 + k % 2 for k in range(14)}
    rows = rows_of(sizes)
    assert found(manifest.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_nulls_repeats_and_single_rows(spark):
    rows = [(None, None, None, None, None, 1, "p"), (None, "s", None, 5, "x", 1, "p"), (None, "s", None, 5, "x", 1, "p"),
            (4, "s", "de", 1, "A" * 200_000, 1, "p"), (4, "s", "de", 1, "b", 1, "p"), (4, "s", "de", 1, "b", 2, "q")]
    assert found(manifest.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    one = rows[3:4]
    alone = manifest.manifest(spark.createDataFrame(one, SCHEMA)).first()
    assert alone.leaf == alone.subroot == alone.root == leaf(one[0]) and alone.path == []
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sources_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(manifest, "FEW_SOURCES", 2)
    rows = rows_of({None: 2, "a": 20, "b": 1, "c": 5})
    assert found(manifest.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_tampering_is_found(spark):
    rows = rows_of({"a": 40, "b": 3})
    docs = spark.createDataFrame(rows, SCHEMA)
    other = manifest.leaf_hash(*(F.col(c) for c in manifest.HASHED[:4]), F.concat("text", F.lit("!")))
    done = manifest.manifest(docs, carry={"other": F.when(F.col("doc_id") % 2 == 0, other)})
    folded = manifest.fold(F.coalesce("other", "leaf"), F.col("path"))
    for r in done.select("doc_id", "leaf", "other", "root", "path", folded.alias("folded"),
                         manifest.proof_hash(F.col("path")).alias("proof")).collect():
        assert (r.folded == r.root) == (r.other is None)
        assert r.proof == H(*(p.left + p.right for p in r.path))


def test_blocks_are_built_behind_one_shuffle(spark):
    nodes = spark.range(100).selectExpr("id div 60 as tree", "cast(2 as int) as depth", "id as rank", "cast(id as string) as digest")
    seen = []

    class Spy:
        def write(self, df, name):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return df
    manifest._roll_up(nodes, 0, [], Spy())
    assert seen[0].count("Exchange") == 1 and "Join" not in seen[0]


def test_no_join_without_a_key(spark):
    plan = manifest.manifest(spark.createDataFrame(rows_of({"a": 40, "b": 3}), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_query_matches_sql(spark, sf):
    r = compare(spark, duck(sf), "op12_manifest", op12_manifest, ORACLE["op12_manifest"], sf)
    assert r["status"] == "match", r
