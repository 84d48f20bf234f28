import random

import duckdb
import numpy as np
from test_ngram_join import brute, key, near_copies

from drivelake.llm import chosen_path as C
from drivelake.llm import queries


def want(rows, width=2, num=80):
    return sorted(((d, n, c, d == c) for d, n, c in brute(rows, width, num)), key=key)


def got(df):
    return sorted(map(tuple, df.collect()), key=key)


def test_query_by_brute_force_and_sql(spark, sf_dir):
    rows = got(queries.QUERIES["op11_chosen_path"](spark, sf_dir))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows == want(docs) and not all(r[3] for r in rows)
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf_dir}/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE["op11_chosen_path"]).fetchall()) == rows


def test_near_copies_by_brute_force(spark):
    rows = near_copies(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(C.join(spark, docs)) == want(rows)


def test_nodes_that_never_get_small(spark, monkeypatch):
    """Tiles of a few classes at the last depth: large groups meet across tiles."""
    monkeypatch.setattr(C, "SMALL", 3)
    monkeypatch.setattr(C, "DEEP", 4)
    monkeypatch.setattr(C, "GUESTS", 5)
    rng = random.Random(5)
    rows = []
    for g in range(3):
        base = [f"{g}w{rng.randint(0, 300)}" for _ in range(120)]
        rows += [" ".join([*base[: k % 9], f"own{k}", *base[k % 9:]]) for k in range(40)]
    rows = list(enumerate(rows + [rows[0].upper(), rows[50] + " end", "alone here"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(C.join(spark, docs)) == want(rows)
    assert len({r[2] for r in want(rows)}) == 4


def test_hubs_find_the_links_of_all_their_classes(spark, monkeypatch):
    """Every pair of one large node, with the roots as they stand at the start, against the full sets."""
    monkeypatch.setattr(C, "SMALL", 4)
    monkeypatch.setattr(C, "GUESTS", 6)
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 300)}" for _ in range(60)]
    edited = lambda k: [f"own{k}{i}" if rng.random() < 0.06 else w for i, w in enumerate(base)]
    rows = list(enumerate(" ".join(edited(k)) for k in range(60)))
    classes = C.signed(spark.createDataFrame(rows, "doc_id long, text string"), 2).where("n > 0").dropDuplicates(["print"])
    classes = classes.selectExpr("xxhash64(print) as class", "doc_id as low", "print", "n", "tokens", "print as root")
    sets = C.full_sets(spark, spark.createDataFrame(rows, "doc_id long, text string"), classes, 2)
    wide = classes.selectExpr("7L as node", "class").union(classes.selectExpr("8L", "class"))
    found = {(bytes(r.a), bytes(r.b)) for r in C.linked_in_hubs(spark, wide, classes, sets, 80, 100).collect()}
    held = {bytes(r.print): set(np.frombuffer(r.hashes, np.uint64).tolist()) for r in sets.collect()}
    want_pairs = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b])}
    assert {tuple(sorted(p)) for p in found} == want_pairs and len(want_pairs) > 50


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(C.join(spark, odd_docs)) == want(rows)
    assert C.join(spark, no_docs).count() == 0
    clash = spark.createDataFrame([(1, "a b c", 5, 6), (2, "A  b C", 5, 7)], "doc_id long, text string, class int, print int")
    assert got(C.join(spark, clash)) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_recall_of_pairs_at_the_bound():
    """Share of made-up pairs of similarity 0.8 that meet in a node of depth START, against the formula."""
    rng = np.random.default_rng(1)
    met, count = [0, 0], 300
    for _ in range(count):
        common, x, y = (rng.integers(0, 1 << 63, n, np.uint64) for n in (160, 20, 20))
        held = C.tokens([np.concatenate([common, x]), np.concatenate([common, y])])
        row, node = C.first_nodes(held, 0.8)
        one, two = set(node[row == 0].tolist()), set(node[row == 1].tolist())
        met[0] += bool(one & two)
        met[1] += len(row) / 2
    assert met[0] >= count - 1 and C.missed(0.8, C.START) < 1e-5 and C.missed(0.8, C.DEEP) < 1e-3
    assert abs(met[1] / count - C.TREES / 0.8 ** C.START) < 2


def test_similarity_from_tokens():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 1000, np.uint64)
    held = C.tokens([a, a[:800], a[:1], np.concatenate([a[:1], a[:800]])])
    share = (held[0] == held[1]).mean()
    assert abs(share - 0.8) < 0.15 and (held[1] == held[3]).all() and not (held[0] == held[2]).all()


def test_near_copies_do_not_branch_to_the_last_depth(spark, monkeypatch):
    """A group that branching does not part ends two levels below its first nodes, and links as before."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(90):
        at = rng.randrange(400)
        rows.append((k, " ".join([*base[:at], f"own{k}", *base[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    classes = C.signed(docs, 2).selectExpr("doc_id as class", "tokens").cache()
    made = []
    nodes = C._nodes
    monkeypatch.setattr(C, "_nodes", lambda rows, bound: made.append(rows) or nodes(rows, bound))
    ends = {tuple(r) for r in C.tiles(spark, classes, 0.8).select("node", "class").collect()}
    branched = [rows.count() for rows in made[1:]]  # by level
    assert 3 * sum(branched[2:]) < branched[1]
    monkeypatch.setattr(C, "KEPT", 2.0)
    made.clear()
    C.tiles(spark, classes, 0.8)
    assert 3 * made[3].count() > branched[1]
    assert len({c for _, c in ends}) == len(rows)
    assert got(C.join(spark, docs)) == want(rows)
