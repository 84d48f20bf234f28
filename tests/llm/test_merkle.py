import hashlib
import random
import re
import zlib

import duckdb
import pytest

from drivelake.llm import merkle as M
from drivelake.llm import queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(levels, k, h):
    """The siblings of node k, and what h at its place folds to."""
    out = []
    for level in levels[:-1]:
        a = k // M.FAN * M.FAN
        left, right = level[a:k], level[k + 1: a + M.FAN]
        out += left + right
        h, k = digest(*left, h, *right), k // M.FAN
    return out, h


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i: i + M.FAN]) for i in range(0, len(levels[-1]), M.FAN)])
    return levels


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the query's rows, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for k, (_, _, h, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), r[4]) if r[4] is not None else None
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            own, a = climb(trees[s], k, leaf((*r[:4], low)) if hit else h)
            upper, a = climb(top, i, a)
            out.append((r[0], h, trees[s][-1][0], top[-1][0], digest(*own, *upper), a, a == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_by_brute_force_and_sql(spark, sf_dir):
    rows = got(queries.QUERIES["op13_merkle_manifest"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS).collect()
    assert rows == brute([tuple(r) for r in docs])
    assert {r[6] for r in rows} == {True, False}
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf_dir}/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE["op13_merkle_manifest"]).fetchall(), key=str) == rows


@pytest.mark.parametrize("sizes", [(1,), (70, 1, 9, 8, 64, 65), (3, *[1] * 20)])
def test_rounds_of_blocks(spark, monkeypatch, sizes):
    """Two children a node: blocks of eight, so that trees and the tree over them take several rounds."""
    for name, value in (("FAN", 2), ("BLOCK", 8), ("RUN", 128)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(sum(sizes))
    ids = rng.sample(range(10_000), sum(sizes))
    rows = [(ids.pop(), None if k == 1 else f"s{k}é", "en", None, f"Text {rng.random()}") for k, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert got(M.verification(spark, docs)) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.source, None, None, r.text) for r in odd_docs.collect()]
    assert got(M.verification(spark, odd_docs)) == brute(rows)
    clash = spark.createDataFrame([(1, "A", "x", "t", 1, "p"), (1, "A", "x", "t", 2, "q"), (5, None, "", None, 3, "r")],
                                  "doc_id int, text string, source string, tree string, at int, path string")
    assert got(M.verification(spark, clash)) == brute([(r.doc_id, r.source, None, None, r.text) for r in clash.collect()])
    assert M.verification(spark, no_docs).count() == 0


def test_proofs_hold_for_the_leaf_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in M.manifest(spark, docs).limit(20).collect():
        h = r.leaf
        for left, right in r.path:
            h = digest(left, h, right)
        assert h == r.root and len(r.path) > 1
