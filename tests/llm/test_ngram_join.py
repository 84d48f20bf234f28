import random
import re

import duckdb
import numpy as np

from drivelake.llm import ngram_join as N
from drivelake.llm import queries


def grams(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width=4, num=85, den=100):
    """(doc_id, set size, component_id) of rows (doc_id, text), by their numbers."""
    sets = [grams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)) and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def test_query_by_brute_force_and_sql(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.QUERIES["op6_ngram_join"](spark, sf_dir).collect())
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got == sorted(brute(docs)) and len({r[2] for r in got}) < len(got)
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf_dir}/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE["op6_ngram_join"]).fetchall()) == got


def near_copies(seed, groups=6, copies=25):
    """Groups whose members differ by about as much as the bound allows, over shared passages."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choices(vocab, k=30)) for _ in range(3)]
    texts = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randint(5, 90)) + rng.choice(passages).split()
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
    texts += [" ".join(rng.choices(vocab, k=rng.randint(0, 6))) for _ in range(20)] + [passages[0].upper(), "\t" + passages[0] + "\n"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_copies_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE", 4)
    monkeypatch.setattr(N, "BLOCK_BYTES", 2000)
    for seed, widths in ((0, ((4, 85),)), (1, ((5, 80),))):
        rows = near_copies(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        for width, num in widths:
            got = N.join(spark, docs, width=width, num=num).select("doc_id", "n_shingles", "component_id").collect()
            assert sorted(map(tuple, got)) == sorted(brute(rows, width, num))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [tuple(r)[:3] for r in N.join(spark, odd_docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert N.join(spark, no_docs).count() == 0


def test_one_of_each(spark, odd_docs, no_docs):
    rows = near_copies(7)
    docs = spark.createDataFrame([(i, t, i) for i, t in rows] + [(0, rows[0][1], 0)], "doc_id long, text string, part int")
    got = N.one_of_each(spark, docs)
    want = sorted(i for i, n, c in brute(rows, 5, 80) if c == i or not n)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want
    odd = N.one_of_each(spark, odd_docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in odd if (r.text or "").strip()) == sorted({(str(r.doc_id), r.text) for r in odd_docs.collect() if (r.text or "").strip()})
    assert len([r for r in odd if not (r.text or "").strip()]) == 5
    assert N.one_of_each(spark, no_docs).count() == 0


def test_shingle_sets_are_as_distinct_as_the_words():
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b", "A", "é", " ", "\n", "\x0b", " ", "\x1c", "ab"], k=rng.randint(0, 60))) for _ in range(400)]
    for width in (1, 4, 5):
        sets = N.shingle_sets([t.encode() for t in texts], width)
        want = [grams(t, width) for t in texts]
        assert [len(s) for s in sets] == [len(w) for w in want]
        named = {}
        for s, w in zip(sets, want):
            if len(w) == 1:
                named.setdefault(next(iter(w)), set()).add(int(s[0]))
        assert all(len(v) == 1 for v in named.values())
        for i in range(0, 400, 2):
            assert len(np.intersect1d(sets[i], sets[i + 1])) == len(want[i] & want[i + 1])


def test_components_of_many_pieces(spark, monkeypatch):
    rng = random.Random(4)
    chain = list(range(0, 600, 2))
    rng.shuffle(chain)
    edges = [*zip(chain, chain[1:]), *[(701, k) for k in range(703, 803, 2)], *[(k, k) for k in (901, 903)], (5, 3), (3, 5), (5, 3)]
    rng.shuffle(edges)
    want = {**{k: 0 for k in chain}, **{k: 701 for k in range(703, 803, 2)}, 701: 701, 3: 3, 5: 3}
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    for piece in (150, 1_000_000):
        monkeypatch.setattr(N, "EDGES", piece)
        got = N.components(spark, frame, "test-comp").collect()
        assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert N.components(spark, frame.limit(0), "test-comp").count() == 0
