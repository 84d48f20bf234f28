import re
from collections import Counter
from itertools import permutations

import duckdb

from drivelake.llm import filter_audit as A
from drivelake.llm import queries

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def failed(text, e):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, x in (("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)), ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
                           ("D", re.search(r"[#$%&*|]", text)), ("E", e)) if x}


def brute(docs, labels):
    """Apply every order filter by filter; docs (doc_id, source, text), labels (doc_id, quality, toxic)."""
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    first = {}
    for d, _, t in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    parts = {}
    for d, s, t in docs:
        parts.setdefault(s or "", []).append((d, failed(t or "", d is not None and d > first[t or ""])))
    out = []
    for part, rows in parts.items():
        shapley, own = Counter(), []
        for order in ORDERS:
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                own.append([part, order, step, len(left), len(gone), sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                            sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f])
        out += [(*r[:-1], shapley[r[-1]]) for r in own]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_intervals_are_what_each_order_does():
    assert [A.order_of(r) for r in range(A.ORDERS)] == ORDERS
    for mask in range(32):
        held = {f for k, f in enumerate("ABCDE") if mask >> k & 1}
        step = {r: s for s, lo, hi in A.intervals(mask) for r in range(lo, hi)}
        assert sum(hi - lo for _, lo, hi in A.intervals(mask)) == len(step) == (120 if mask else 0)
        assert all(min(o.index(f) for f in held) + 1 == step[r] for r, o in enumerate(ORDERS) if held)


def test_query_by_brute_force_and_sql(spark, sf_dir):
    rows = got(queries.QUERIES["op12_filter_audit"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    assert rows == brute(docs, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    assert sorted(con.sql(queries.ORACLE["op12_filter_audit"]).fetchall()) == rows


def test_masks_at_their_bounds(spark):
    w = [f"w{i}" for i in range(100)]
    texts = [" ".join(w[:50]), " ".join(w[:49]), " ".join(w[:65] + w[:35]), " ".join(w[:64] + w[:36]), "AB" + "c" * 38, "ABC" + "d" * 37, "a|b", "", None, "", " \x0b", "É" * 60]
    rows = [(i, "s" if i % 2 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    labels = [(0, 1, 0), (3, 0, 1), (3, 1, None), (None, 1, 1), (99, 1, 1), (9, None, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(A.audit(spark, docs, frame)) == brute(rows, labels)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    assert got(A.audit(spark, odd_docs, labels)) == brute(rows, [])
    assert A.audit(spark, no_docs, labels).count() == 0
