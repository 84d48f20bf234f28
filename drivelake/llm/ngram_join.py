"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two link
when intersection / union >= num / den. The product of the incidence matrix
with its transpose is never formed whole; its columns go in blocks and its
entries are bounded by the sizes of the sets:

1. Columns are dealt over blocks by hash. A block tells which of its columns
   more than one set holds. A set with too few such columns for its size
   (fewer than num / den of it) links with nothing and leaves the matrix.
   Rows travel packed, some thousand documents at a time, and what a pack
   holds twice itself it does not send to be counted, so a column that a third
   of all documents hold sends one entry per pack.
2. Equal sets become one row (a class); the rest goes through the columns once
   more, which gives the number of classes per column.
3. Columns of a row are taken from the rarest on. Two rows that link share one
   among their first n - ceil(n * num / den) + 1, so only these make candidates,
   with bounds from the sizes and from what overlap the places still allow.
   Columns held by many are split in tiles.
4. First neighbours (by size) in each tile are compared, and linked rows become
   components, in rounds that reach further in the columns which still hold several
   components; then all pairs of rows of different components. So a large group of
   near copies does not make all its pairs, yet no link between components is lost. Overlaps are counted on the whole sets, exactly.

Components come from stars within bounded pieces of the links, joined by
smallest-neighbour steps; each step is written to the shared folder, nothing is
collected.

Rows: null, empty and white texts have the empty set and link with nothing (a
text with fewer words than n is one n-gram). Rows with equal sets link whether
or not their ids differ; a null doc_id takes part, and counts for a component's
smallest id only if the component has no other. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import released, slices, texts_of, written

#: Bytes of text in a block of columns, on average; rows of a column in a tile.
BLOCK_BYTES, TILE = 8_000_000, 256
#: Neighbours by size that a row is compared with, in each round before all pairs of different components.
NEAR = (1, 6, 24)
#: Sets in a pack at most: their number takes 16 bits beside the 48 of a hash.
PACK = 32_768
#: Links that one task contracts at once; more links make more tasks.
EDGES = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WEIGHT = np.random.default_rng(6).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text (A-Z lower-cased; words between ASCII white space)."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts = np.flatnonzero(edge == -1)
    ends = np.flatnonzero(np.concatenate([edge[1:], [0]]) == 1) + 1
    ends = ends[: len(starts)]
    longest = int((ends - starts).max(initial=0))
    power = np.cumprod(np.full(longest + 1, _BASE, np.uint64))
    at_start = np.zeros(len(data), np.int64)
    at_start[starts] = starts
    place = np.minimum(np.arange(len(data)) - np.maximum.accumulate(at_start), longest)
    terms = np.where(space, np.uint64(0), _WEIGHT[data] * power[place])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    words = _mixed(total[ends] - total[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, bounds)
    sets, at = [], 0
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        grams = _mixed(grams + words[k: len(words) - width + 1 + k] * (_BASE + np.uint64(2 * k))) if len(grams) else grams
    for stop in last.tolist():
        n = stop - at
        if n >= width:
            sets.append(np.unique(grams[at: stop - width + 1]))
        elif n:
            short = np.uint64(n)
            for w in words[at:stop]:
                short = _mixed(np.array([short * _BASE + w], np.uint64))[0]
            sets.append(np.array([short], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        at = stop
    return sets


def _prints(sets: list[np.ndarray]) -> list[bytes]:
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"" for s in sets]


# ---- packs: rows of the matrix on their way through the columns

_PACKED = pa.schema([("block", pa.int32()), ("pack", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_ENTRY, _MARK, _KNOWN, _HEAD = 0, 1, 2, 3


def _emit(pack: int, sets: list[np.ndarray], head: bytes, blocks: int, exact: bool) -> Iterator[pa.RecordBatch]:
    """Entries by block of columns, and the head, which passes through to the pack.

    An entry is 48 bits of the hash and 16 of the row. Unless exact counts are
    wanted, columns that the pack itself holds more than once go as known
    entries, dealt by pack, and one mark tells their block of them.
    """
    out = [(pack % blocks, pack, _HEAD, head)]
    if sets:
        h = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
        block = (h % np.uint64(blocks)).astype(np.uint16 if blocks <= 65_536 else np.int64)
        value = (h // np.uint64(blocks)) << np.uint64(16) & ~np.uint64(0xFFFF) | row
        order = np.argsort(value)
        order = order[np.argsort(block[order], kind="stable")]
        block, value = block[order], value[order]
        same = np.zeros(len(value), bool)
        if len(value) > 1 and not exact:
            twin = (value[1:] >> np.uint64(16) == value[:-1] >> np.uint64(16)) & (block[1:] == block[:-1])
            same[1:] |= twin
            same[:-1] |= twin
            first = same.copy()
            first[1:] &= ~twin
        else:
            first = same
        cuts = np.searchsorted(block, np.arange(blocks + 1))
        for b in np.unique(block).tolist():
            s = slice(cuts[b], cuts[b + 1])
            single, marks, known = value[s][~same[s]], value[s][first[s]], value[s][same[s]]
            if len(single):
                out.append((b, pack, _ENTRY, single.tobytes()))
            if len(marks):
                out.append((b, pack, _MARK, marks.tobytes()))
            if len(known):  # to any block: it only passes on
                out.append(((b + pack) % blocks, pack, _KNOWN, struct.pack("<i", b) + known.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*out), _PACKED)], schema=_PACKED)


def _meet(table: pa.Table) -> pa.Table:
    """One block: its entries whose column has another entry or a mark, with the number of entries, by pack."""
    block = table.column("block")[0].as_py()
    kinds, packs, data = (table.column(c).to_pylist() for c in ("kind", "pack", "payload"))
    out = [(p, k, struct.pack("<i", block) + d if k == _ENTRY else d) for p, k, d in zip(packs, kinds, data) if k in (_KNOWN, _HEAD)]
    held = [(p, k, np.frombuffer(d, "<u8")) for p, k, d in zip(packs, kinds, data) if k in (_ENTRY, _MARK)]
    if held:
        value = np.concatenate([v for _, _, v in held])
        column = value >> np.uint64(16)
        _, inverse, count = np.unique(column, return_inverse=True, return_counts=True)
        df = np.minimum(count, 0x7FFFFFFF).astype("<u4")[inverse]
        at = 0
        for p, k, v in held:
            own = df[at: at + len(v)]
            at += len(v)
            if k == _ENTRY and (own > 1).any():
                keep = own > 1
                out.append((p, _ENTRY, struct.pack("<i", block) + v[keep].tobytes() + own[keep].tobytes()))
    return pa.table([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())],
                    names=["pack", "kind", "payload"])


def _gather(table: pa.Table, blocks: int) -> tuple[bytes, list[np.ndarray], list[np.ndarray]]:
    """The head of a pack, and per row its shared hashes and their counts (0 where only known to be shared)."""
    head, values, counts, of = b"", [], [], []
    for k, d in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()):
        if k == _HEAD:
            head = d
            continue
        n = (len(d) - 4) // (12 if k == _ENTRY else 8)
        values.append(np.frombuffer(d, "<u8", n, 4))
        counts.append(np.frombuffer(d, "<u4", n, 4 + 8 * n) if k == _ENTRY else np.zeros(n, "<u4"))
        of.append(np.full(n, struct.unpack_from("<i", d)[0], np.uint64))
    value = np.concatenate(values) if values else np.zeros(0, np.uint64)
    count = np.concatenate(counts) if values else np.zeros(0, "<u4")
    row = (value & np.uint64(0xFFFF)).astype(np.int64)
    h = (value >> np.uint64(16)) * np.uint64(blocks) + (np.concatenate(of) if of else np.zeros(0, np.uint64))
    order = np.lexsort((h, row))
    row, h, count = row[order], h[order], count[order]
    rows = int(row.max(initial=-1)) + 1
    cuts = np.searchsorted(row, np.arange(rows + 1))
    return head, [h[cuts[i]: cuts[i + 1]] for i in range(rows)], [count[cuts[i]: cuts[i + 1]] for i in range(rows)]


def _through(packed: DataFrame) -> DataFrame:
    return packed.groupBy("block").applyInArrow(_meet, "pack long, kind int, payload binary")


def _need(n: int, num: int, den: int) -> int:
    return -(-n * num // den)


def document_sets(docs: DataFrame, width: int, num: int, den: int, blocks: int) -> DataFrame:
    """(doc_id, n, print, blob, part) of all documents; blob is the SHA-256 of the text, part has the hashes that others share, for sets that may link."""

    def pack(batches):
        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, chars=3_000_000):
                for i in range(0, rows.num_rows, PACK):
                    part = rows.slice(i, PACK)
                    sets = shingle_sets([x.as_buffer().to_pybytes() for x in part.column(1)], width)
                    prints = _prints(sets)
                    seen: set[bytes] = set()
                    own = []
                    for s, p in zip(sets, prints):  # equal sets of a pack send their columns once
                        own.append(s if p not in seen else s[:0])
                        seen.add(p)
                    sink = pa.BufferOutputStream()
                    heads = pa.table({"doc_id": part.column(0), "n": pa.array([len(s) for s in sets], pa.int64()), "print": pa.array(prints, pa.binary()),
                                      "blob": pa.array([hashlib.sha256(x.as_buffer()).digest() for x in part.column(1)], pa.binary())})
                    with pa.ipc.new_stream(sink, heads.schema) as w:
                        w.write_table(heads)
                    yield from _emit((task << 32) + number, own, sink.getvalue().to_pybytes(), blocks, False)
                    number += 1

    def finish(table):
        head, hashes, _ = _gather(table, blocks)
        rows = pa.ipc.open_stream(head).read_all().combine_chunks()
        ns = rows.column("n").to_pylist()
        part = [hashes[i].tobytes() if i < len(hashes) and n and len(hashes[i]) >= _need(n, num, den) else None for i, n in enumerate(ns)]
        return rows.append_column("part", pa.array(part, pa.binary()))

    packed = texts_of(docs).mapInArrow(pack, "block int, pack long, kind int, payload binary")
    return _through(packed).groupBy("pack").applyInArrow(finish, "doc_id long, n long, print binary, blob binary, part binary")


def class_rows(sets: DataFrame, num: int, den: int, blocks: int) -> DataFrame:
    """(print, n, hashes, first): one row per class that may link; first has (hash, number of classes, place) of its candidate columns."""
    own = sets.where("part is not null")
    # a class may have sent its columns from several packs; one row of each is enough
    one = own.groupBy("print").agg(F.min(F.struct("n", "part")).alias("x")).select("print", "x.n", "x.part")

    def pack(batches):
        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, "part"):
                for i in range(0, rows.num_rows, PACK):
                    part = rows.slice(i, PACK)
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema.remove(2)) as w:
                        w.write_batch(part.select(["print", "n"]))
                    yield from _emit((task << 32) + number, [np.frombuffer(x, "<u8") for x in part.column(2).to_pylist()], sink.getvalue().to_pybytes(), blocks, True)
                    number += 1

    def finish(table):
        head, hashes, counts = _gather(table, blocks)
        rows = pa.ipc.open_stream(head).read_all().to_pylist()
        out = {"print": [], "n": [], "hashes": [], "first": []}
        for i, r in enumerate(rows):
            h, c = (hashes[i], counts[i]) if i < len(hashes) else (np.zeros(0, np.uint64), np.zeros(0, "<u4"))
            need = _need(r["n"], num, den)
            if len(h) < need:
                continue
            order = np.lexsort((h, c))[: len(h) - need + 1]  # the set's columns without company come before all these
            lead = r["n"] - len(h)
            out["print"].append(r["print"])
            out["n"].append(r["n"])
            out["hashes"].append(h.view(np.int64))
            out["first"].append([{"h": int(h[j].view(np.int64)), "df": int(c[j]), "at": lead + k} for k, j in enumerate(order)])
        return pa.table([pa.array(out["print"], pa.binary()), pa.array(out["n"], pa.int64()), pa.array(out["hashes"], pa.list_(pa.int64())),
                         pa.array(out["first"], pa.list_(pa.struct([("h", pa.int64()), ("df", pa.int64()), ("at", pa.int64())])))], names=list(out))

    packed = one.mapInArrow(pack, "block int, pack long, kind int, payload binary")
    return _through(packed).groupBy("pack").applyInArrow(finish, "print binary, n long, hashes array<long>, first array<struct<h:long,df:long,at:long>>")


# ---- candidates, links, components

def _may(a, b, num: int, den: int):
    """Bounds from the sizes, and from the places of a shared column: overlap o of n and m needs o (num + den) >= num (n + m)."""
    least = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return ((den * F.least(f"{a}.n", f"{b}.n") >= num * F.greatest(f"{a}.n", f"{b}.n"))
            & (least * (num + den) >= num * (F.col(f"{a}.n") + F.col(f"{b}.n"))))


def _linked(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link; the overlap is counted on the whole sets."""
    left = rows.select(F.col("print").alias("a"), F.col("n").alias("an"), F.col("hashes").alias("ah"))
    right = rows.select(F.col("print").alias("b"), F.col("n").alias("bn"), F.col("hashes").alias("bh"))
    both = pairs.join(left, "a").join(right, "b")
    over = F.size(F.array_intersect("ah", "bh"))
    return both.where(over * (num + den) >= num * (F.col("an") + F.col("bn"))).select("a", "b")


def _stars(u: pa.ChunkedArray, v: pa.ChunkedArray) -> pa.RecordBatch:
    """The components of some edges, each as a star: every node but the smallest, with the smallest."""
    nodes = pa.chunked_array([*u.chunks, *v.chunks]).unique()
    nodes = nodes.take(pc.sort_indices(nodes))
    left, right = (pc.index_in(c, value_set=nodes).to_numpy() for c in (u, v))
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        if (label[left] == low).all() and (label[right] == low).all():
            break
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while (label[label] != label).any():
            label = label[label]
    leaf = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(leaf)), nodes.take(pa.array(label[leaf]))], ["u", "v"])


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) as stars of EDGES edges at a time: as many tasks as that takes, and none holds more."""
    def stars(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= EDGES:
                yield _stars(*pa.Table.from_batches(held).columns)
                held = []
        if held:
            yield _stars(*pa.Table.from_batches(held).columns)

    return edges.coalesce(-(-edges.count() // EDGES) or 1).mapInArrow(stars, edges.schema)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("k"), F.col("v").alias("c"), F.lit(False).alias("centre")).union(edges.select("v", F.lit(None), F.lit(True)))
    nodes = ends.groupBy("k").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max("centre").alias("centre"))
    return nodes.where("low <> high or (centre and low is not null)").isEmpty()


def components(spark: SparkSession, edges: DataFrame, tag: str) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): root is the smallest node of the component.

    Edges are contracted to stars within bounded pieces; large-star and small-star steps join
    the pieces. Both repeat, each written, until stars are left that share no node.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        edges = written(_contracted(edges), spark, tag)
        if _all_stars(edges):
            break
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = written(small, spark, tag)
    edges = edges.distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def _rooted(spots: DataFrame, root: DataFrame) -> DataFrame:
    return spots.join(root, spots.print == root.node, "left").withColumn("root", F.coalesce("root", "print")).drop("node")


def _undecided(own: DataFrame) -> DataFrame:
    """The rows of columns that hold more than one component."""
    several = own.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("h")
    return own.join(several, "h", "left_semi")


def _merged(spark: SparkSession, root: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components of earlier ones (node, root) and further links (a, b), which need not come from their roots."""
    if root is None:
        return components(spark, links, "join-comp")
    if links.isEmpty():
        return root
    return components(spark, root.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links), "join-comp")


def class_components(spark: SparkSession, rows: DataFrame, num: int, den: int) -> DataFrame:
    """(node, root) of the classes that link with another."""
    spots = rows.select("print", "n", F.explode("first").alias("x")).select("print", "n", "x.*")
    spots = spots.withColumn("tiles", F.ceil(F.col("df") / TILE)).withColumn("tile", F.pmod(F.xxhash64("h", "print"), "tiles"))
    spots = written(spots, spark, "join-spots")
    by_size, root = W.partitionBy("h", "tile").orderBy("n", "print"), None
    for reach in NEAR:
        own = spots.withColumn("root", F.col("print")) if root is None else _undecided(_rooted(spots, root))
        me = F.struct("print", "n", "at", "root")
        d = own.select(me.alias("x"), F.array(*[F.lead(me, k).over(by_size) for k in range(1, reach + 1)]).alias("ys"))
        other = F.filter("ys", lambda y: y["root"] != F.col("x.root"))  # null beyond the last row
        near = d.select("x", F.explode(other).alias("y")).where(_may("x", "y", num, den))
        near = near.select(F.least("x.print", "y.print").alias("a"), F.greatest("x.print", "y.print").alias("b")).distinct()
        found = written(_linked(written(near, spark, "join-near"), rows, num, den), spark, "join-links")
        root = _merged(spark, root, found)
        released(spark)

    own = _rooted(spots, root)
    own = written(own, spark, "join-own")
    # of each column, only its rows outside the component that holds most of them seek partners there
    most = own.groupBy("h", "root").agg(F.count("*").alias("held")).groupBy("h").agg(F.max(F.struct("held", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1")
    own = own.join(most.select("h", F.col("m.root").alias("major")), "h")
    cell = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    x = own.where("root <> major").select("h", cell.alias("tile"), F.struct("print", "n", "at", "root").alias("x"))
    y = own.select("h", "tile", F.struct("print", "n", "at", "root").alias("y"))
    far = x.join(y, ["h", "tile"]).where((F.col("x.root") != F.col("y.root")) & _may("x", "y", num, den))
    far = far.select(F.least("x.print", "y.print").alias("a"), F.greatest("x.print", "y.print").alias("b")).distinct()
    second = written(_linked(written(far, spark, "join-far"), rows, num, den), spark, "join-links")
    return _merged(spark, root, second)


def join(spark: SparkSession, docs: DataFrame, *, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, print (which equal sets share; empty for the empty set), root, blob."""
    texts = texts_of(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    sets = written(document_sets(docs, width, num, den, blocks), spark, "join-sets")
    released(spark)
    rows = written(class_rows(sets, num, den, blocks), spark, "join-rows")
    released(spark)
    root = class_components(spark, rows, num, den)
    classes = sets.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("low"))
    named = classes.join(root, classes.print == root.node, "left").withColumn("root", F.coalesce("root", "print")).select("print", "low", "root")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(lows, "root").select("print", "component_id", "root")
    out = sets.select("doc_id", "n", "print", "blob").join(found, "print", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      "print", "root", "blob")


def one_of_each(spark: SparkSession, docs: DataFrame, *, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, with all their columns, one of each component: that with the smallest doc_id (then content hash).

    Texts without words stay. Of rows with one id and one text, one stays. A row without an id
    stays only if its component has no id at all.
    """
    found = written(join(spark, docs, width=width, num=num, den=den), spark, "join-found")
    some = found.where("n_shingles > 0")
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    first = some.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), last.alias("key"), "blob")).alias("x")).select("x.key", F.hex("x.blob").alias("hex"))
    stay = first.union(found.where("n_shingles = 0").select(last.alias("key"), F.hex("blob").alias("hex")).distinct())
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"),
                       F.upper(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("hex"))
    rows = rows.join(stay, ["key", "hex"], "left_semi")
    twice = some.groupBy(last.alias("key"), F.hex("blob").alias("hex")).count().where("count > 1").select("key", "hex")
    if twice.limit(1).count():
        again = rows.join(twice, ["key", "hex"], "left_semi").dropDuplicates(["key", "hex"])
        rows = rows.join(twice, ["key", "hex"], "left_anti").unionByName(again)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
