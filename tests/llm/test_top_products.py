import duckdb
import numpy as np

from drivelake.llm import queries
from drivelake.llm import top_products as T


def brute(rows, k, every, scale):
    good = [(i, np.floor(scale * np.array(v, float)).astype(np.int64)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (qi, q) in enumerate(good):
        if qi % every == 0:
            found = sorted((-int(q @ v), i) for m, (i, v) in enumerate(good) if m != n and len(v) == len(q))[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_query_by_sql_and_brute_force(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.QUERIES["op4_top_products"](spark, sf_dir).collect())
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{sf_dir}/embeddings.parquet'")
    assert got == sorted(con.sql(queries.ORACLE["op4_top_products"]).fetchall())
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert got == brute(rows, 5, 50, 256.0)


def test_many_blocks_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 40)
    monkeypatch.setattr(T, "QUERIES_IN_BLOCK", 7)
    monkeypatch.setattr(T, "HEAD", 16)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=20) * rng.choice([0.1, 1, 5])).tolist()) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(150)] + [(7, rows[7][1]), (0, rows[0][1])]
    rows += [(500, None), (510, []), (520, [None] * 20), (530, [float("nan")] * 20), (540, [float("inf")] + [0.0] * 19), (None, [1.0] * 20), (550, [1.0] * 3), (551, [2.0] * 3), (560, [9.0] * 2), (570, [0.0] * 20)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, row int").repartition(3)
    got = sorted(tuple(r) for r in T.top_products(spark, docs, k=5, every=10, scale=16.0).collect())
    assert got == brute(rows, 5, 10, 16.0)
    assert T.top_products(spark, docs.limit(0)).count() == 0
