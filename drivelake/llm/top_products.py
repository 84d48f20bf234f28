"""Exact top-k inner products of integer vectors.

A component x becomes floor(scale * x). Vectors are taken by descending length,
in blocks. Both sides are rotated by the right singular vectors of all vectors
(from their summed Gram matrix), so that the first dimensions hold most of a
product; the rest of a product is at most the product of the rests' lengths
(Cauchy-Schwarz). A query looks first at the longest vectors, which gives it a
bound to beat; then whole blocks whose longest vector cannot reach the bound
are not paired with it, and within a block a vector whose partial product plus
residual bound stays below is not scored. Scores of the others are exact integers.

Queries and vectors travel in packed blocks; a pair of blocks is one task's work
at a time, and of each only k rows a query go on.

Rows: vectors that are null, empty or hold null or non-finite components, and
rows without an id, take no part. Vectors of different lengths have no product.
Ties go to the smaller id. Of rows with one id, each is a vector of its own and
a query of its own; a row is never its own answer. Scores must fit in 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import written

#: Vectors in a block, queries in a block, vectors that a query sees first; rotated dimensions scored at once.
BLOCK, QUERIES_IN_BLOCK, HEAD, STEP = 4096, 512, 1024, 16


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v array<long>, dim, norm), by the rules of this module."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    good = F.col(f"`{id_col}`").isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = vectors.where(F.coalesce(good, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return own.select("id", "v", F.size("v").alias("dim"), norm.alias("norm"))


def _matrix(column, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension, the right singular vectors of its vectors, from Gram matrices that tasks sum (dim * dim numbers each)."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = np.array(b.column(1).to_pylist())
            for d in np.unique(dims).tolist():
                m = _matrix(b.filter(pa.array(dims == d)).column(0), d).astype(np.float64)
                sums[d] = sums.get(d, 0) + m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.ravel().tolist() for s in sums.values()], pa.list_(pa.float64()))], ["dim", "gram"])

    parts = rows.select("v", "dim").mapInArrow(run, "dim int, gram array<double>")
    total = parts.select("dim", F.posexplode("gram").alias("at", "x")).groupBy("dim", "at").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for r in total.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("g")).collect():  # dim * dim numbers for each dimension
        _, vectors = np.linalg.eigh(np.array([x.x for x in r.g]).reshape(r.dim, r.dim))
        out[r.dim] = vectors[:, ::-1].copy()
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score, then smaller id."""
    return np.lexsort((ids, -score))[:k]


def _search(q_row, q_id, q, bound, c_row, c_id, c, rotation, k):
    """k best of the block for every query that may reach its bound: (query place, id, score)."""
    qr, cr = q.astype(np.float64) @ rotation, c.astype(np.float64) @ rotation
    qn, cn = np.linalg.norm(q.astype(np.float64), axis=1), np.linalg.norm(c.astype(np.float64), axis=1)
    slack = 1e-7 * (1 + qn.max(initial=0) * cn.max(initial=0))
    live = np.ones((len(q), len(c)), bool) & (q_row[:, None] != c_row[None, :])
    live &= qn[:, None] * cn[None, :] + slack >= bound[:, None]
    part = np.zeros((len(q), len(c)))
    for at in range(0, rotation.shape[0], STEP):
        part += qr[:, at: at + STEP] @ cr[:, at: at + STEP].T
        q_rest, c_rest = np.linalg.norm(qr[:, at + STEP:], axis=1), np.linalg.norm(cr[:, at + STEP:], axis=1)
        live &= part + q_rest[:, None] * c_rest[None, :] + slack >= bound[:, None]
        if at == 0:  # a bound of the block's own: the k-th best partial product less what the rest can take away
            low = np.where(live, part - q_rest[:, None] * c_rest[None, :] - slack, -np.inf)
            if low.shape[1] > k:
                bound = np.maximum(bound, np.partition(low, -k, axis=1)[:, -k])
                live &= part + q_rest[:, None] * c_rest[None, :] + slack >= bound[:, None]
        if not live.any():
            return []
    out = []
    for i in np.flatnonzero(live.any(axis=1)).tolist():
        spots = np.flatnonzero(live[i])
        score = c[spots] @ q[i]
        for j in _best(score, c_id[spots], k).tolist():
            out.append((i, int(c_id[spots[j]]), int(score[j])))
    return out


def by_length(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Adds block: the place of a vector by descending length among those of its dimension, ``BLOCK`` to a block.

    Places come from a range sort and the counts of its sorted pieces, so neither the plan nor the driver
    holds anything for each block.
    """
    order = [F.col("dim"), F.desc("norm"), F.col("row")]
    d = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    d = written(d, spark, "top-sorted").withColumn("piece", F.shiftright("at", 33))  # the upper bits are the number of the sorted piece
    pieces = d.groupBy("dim", "piece").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    before = W.partitionBy("dim").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select("dim", "piece", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at") - F.col("first")
    return d.join(pieces, ["dim", "piece"]).withColumn("block", F.floor(place / BLOCK).cast("int")).drop("piece", "at", "first", "before")


def top_products(spark: SparkSession, vectors: DataFrame, *, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): queries are the rows whose id is divisible by ``every``."""
    rows = written(usable(vectors, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id()), spark, "top-vectors")
    rotation = spark.sparkContext.broadcast(rotations(rows))  # dim * dim numbers
    if rows.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocked = by_length(spark, rows)

    def packed(df, key):
        def run(table):
            d = table.column("dim")[0].as_py()
            m = _matrix(table.column("v"), d).astype("<i8")
            order = np.argsort(-np.array(table.column("norm").to_pylist()), kind="stable")
            one = lambda c: np.array(table.column(c).to_pylist(), "<i8")[order].tobytes()
            return pa.table([pa.array([d], pa.int32()), pa.array([table.column(key)[0].as_py()], pa.int32()), pa.array([max(table.column("norm").to_pylist())], pa.float64()),
                             pa.array([m[order].tobytes()], pa.binary()), pa.array([one("id")], pa.binary()), pa.array([one("row")], pa.binary())], names=["dim", key, "top", "v", "ids", "rows"])

        return df.select("dim", key, "v", "id", "row", "norm").groupBy("dim", key).applyInArrow(run, f"dim int, {key} int, top double, v binary, ids binary, rows binary")

    candidates = written(packed(blocked, "block"), spark, "top-blocks")
    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    q_blocks = max(1, -(-(queries.count()) // QUERIES_IN_BLOCK))
    asked = written(packed(queries.withColumn("ask", F.pmod(F.xxhash64("row"), F.lit(q_blocks)).cast("int")), "ask"), spark, "top-queries")

    def first_pass(pairs, head):
        """(query, query_id, id, score) of pairs of blocks; bounds: per query row the score to reach, from an earlier pass."""

        def run(batches):
            turn = rotation.value
            for b in batches:
                for r in b.to_pylist():
                    d = r["dim"]
                    get = lambda c, w=1: np.frombuffer(r[c], "<i8").reshape(-1, w) if w > 1 else np.frombuffer(r[c], "<i8")  # noqa: E731, B023
                    q, c = np.frombuffer(r["q_v"], "<i8").reshape(-1, d), np.frombuffer(r["v"], "<i8").reshape(-1, d)
                    bound = np.frombuffer(r["bound"], "<f8") if r["bound"] else np.full(len(q), -np.inf)
                    q_ids, q_rows, ids, own = get("q_ids"), get("q_rows"), get("ids"), get("rows")
                    found = []
                    for at in range(0, min(len(c), HEAD) if head else len(c), HEAD):
                        s = slice(at, at + HEAD)
                        found += _search(q_rows, q_ids, q, bound, own[s], ids[s], c[s], turn[d], k)
                    cols = list(zip(*found)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(q_rows[list(cols[0])], pa.int64()), pa.array(q_ids[list(cols[0])], pa.int64()), pa.array(cols[1], pa.int64()),
                                                      pa.array(cols[2], pa.int64())], ["query", "query_id", "vec_id", "score"])

        return pairs.mapInArrow(run, "query long, query_id long, vec_id long, score long")

    ask = asked.select("dim", "ask", F.col("top").alias("q_top"), F.col("v").alias("q_v"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"))
    lead = candidates.join(candidates.groupBy("dim").agg(F.min("block").alias("block")), ["dim", "block"])  # the longest vectors
    seen = written(first_pass(ask.join(lead, "dim").withColumn("bound", F.lit(None).cast("binary")).repartition("dim", "ask"), True), spark, "top-first")
    kth = seen.withColumn("at", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("at") == k).select("query", "score")

    def bounds(left, right):
        r = left.to_pylist()[0]
        best = dict(zip(right.column("query").to_pylist(), right.column("score").to_pylist()))
        own = np.array([best.get(q, -np.inf) for q in np.frombuffer(r["q_rows"], "<i8").tolist()], "<f8")
        return pa.Table.from_pylist([{**r, "bound": own.tobytes(), "least": float(own.min())}], schema=left.schema.append(pa.field("bound", pa.binary())).append(pa.field("least", pa.float64())))

    of = rows.select(F.col("row").alias("query"), "dim", F.pmod(F.xxhash64("row"), F.lit(q_blocks)).cast("int").alias("ask"))
    known = ask.groupBy("dim", "ask").cogroup(kth.join(of, "query").groupBy("dim", "ask")).applyInArrow(
        bounds, "dim int, ask int, q_top double, q_v binary, q_ids binary, q_rows binary, bound binary, least double")
    known = written(known, spark, "top-known")
    # a block whose longest vector cannot reach the least bound of a query block is not met
    met = known.select("dim", "ask", "q_top", "least").join(candidates.select("dim", "block", "top"), "dim").where(
        F.col("q_top") * F.col("top") * (1 + 1e-9) >= F.col("least")).select("dim", "ask", "block")
    pairs = met.join(known, ["dim", "ask"]).join(candidates, ["dim", "block"]).repartition("ask", "block")
    found = first_pass(pairs, False)
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
