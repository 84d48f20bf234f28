"""Near duplicates by a chosen-path set similarity join.

A document is the set of its distinct word n-grams, as 64-bit hashes; equal sets
are one class. A class has ``TOKENS`` minwise tokens. A node of a tree chooses
one or two of the token places by its own hash, 1 / similarity of them on
average, and a class in the node goes on to the child of each chosen place and
its token there. So two classes that are as similar as the bound asks share one
child of a common node on average, and meet in a tree of depth 3 with
probability 0.64, of depth 6 with 0.48; ``TREES`` independent trees miss a pair
at the bound with a probability of 4e-6 to 4e-4 (``missed``), one of similarity
0.9 with 1e-9 to 1e-7. A component needs only some of its pairs.

1. Paths of depth ``START`` are made with the tokens. Nodes with one class go,
   nodes of up to ``SMALL`` classes are compared exhaustively, larger ones branch
   on, to depth ``DEEP`` at most. What is still larger there is cut in tiles, and so is
   a node that holds ``KEPT`` of its first node's classes two or more levels below it:
   branching does not part near copies, it only makes more nodes of the same classes.
2. Within a tile all pairs are compared by their tokens; each class proposes one
   partner. Proposals are confirmed on the full sets and make components.
3. Then all pairs of classes of different components that agree in enough tokens
   are confirmed. Large nodes in which the same component holds most classes are one
   hub; it is cut in tiles, the classes outside that component visit all of them, and
   the full sets are compared there, so that only links leave a tile. So a group of
   near copies does not make all its pairs, and no link between components is left out.

``MARGIN`` is how far below the bound the share of equal tokens may lie: four
deviations, so 3e-5 of the pairs at the bound are not looked at in one tile.

Rows: null, empty and white texts have the empty set and link with nothing; a
text with fewer words than n is one n-gram. Rows with equal sets link whether
or not their ids differ. A null doc_id takes part and counts for a component's
smallest id only where all are null (then component_id is null, and such rows
are kept). Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.llm.common import released, slices, texts_of, written
from drivelake.llm.ngram_join import components, shingle_sets

#: Trees; minwise tokens of a class; depth of the first nodes and of the last.
TREES, TOKENS, START, DEEP = 12, 96, 3, 6
#: Classes of a node that is compared at once, and of a tile.
SMALL = 64
#: Share of its first node's classes with which a large node does not branch on.
KEPT = 0.75
#: Deviations of the share of equal tokens below the bound.
MARGIN = 4.0
#: Rows of nodes that one step compares; classes that visit a tile of a hub at once, and rows with full sets that one step holds.
STEP_ROWS, GUESTS, SET_ROWS = 40_000, 1024, 2048
_ODD = np.random.default_rng(11).integers(1, 1 << 63, TOKENS, np.uint64) | np.uint64(1)
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (the finisher of a public generator)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def missed(similarity: float, depth: int, trees: int = TREES, bound: float = 0.8) -> float:
    """Probability that a pair of that similarity shares no node of that depth in any tree."""
    dies, two = 0.0, 1 / bound - 1
    for _ in range(depth):
        one = 1 - similarity + similarity * dies
        dies = (1 - two) * one + two * one * one
    return dies ** trees


def tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Sixteen bits of the minimum of each set (none empty) under each of TOKENS orders."""
    h = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), TOKENS), np.uint16)
    for k, odd in enumerate(_ODD):
        out[:, k] = _mix(np.minimum.reduceat(h * odd, starts)) >> _U(48)
    return out


def branch(row: np.ndarray, node: np.ndarray, held: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Children (row, node) of some rows in nodes; held has the tokens of the rows."""
    x = _mix(node + _U(1))
    first = x % _U(TOKENS)
    y = _mix(x)
    second = (first + _U(1) + y % _U(TOKENS - 1)) % _U(TOKENS)
    two = (_mix(y) >> _U(32)).astype(np.float64) < (1 / bound - 1) * 2.0 ** 32
    made = [(row[m], _mix((x[m] ^ _mix((place[m] << _U(16)) + held[row[m], place[m].astype(np.int64)])) + _U(7)))
            for place, m in ((first, np.ones(len(row), bool)), (second, two))]
    return np.concatenate([r for r, _ in made]), np.concatenate([n for _, n in made])


def first_nodes(held: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) at depth START of all trees; a row's equal nodes count once."""
    row = np.tile(np.arange(len(held)), TREES)
    node = np.repeat(_mix(np.arange(TREES, dtype=np.uint64) + _U(0x5EED)), len(held))
    for _ in range(START):
        row, node = branch(row, node, held, bound)
    return row, node


def signed(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, print, tokens) of all documents; print and tokens are empty for the empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("tokens", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, chars=2_000_000):
                sets = shingle_sets([x.as_buffer().to_pybytes() for x in rows.column(1)], width)
                some = [s for s in sets if len(s)]
                lines = iter(tokens(some)) if some else iter(())
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"" for s in sets], pa.binary()),
                    pa.array([next(lines).tobytes() if len(s) else b"" for s in sets], pa.binary())], schema=schema)

    return texts_of(docs).mapInArrow(sign, "doc_id long, n long, print binary, tokens binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TOKENS)


def _nodes(rows: DataFrame, bound: float) -> DataFrame:
    """(node, class) of the children: of the roots for rows (class, tokens); and top, of its node for rows (class, tokens, node, top)."""
    inner = "node" in rows.columns

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _matrix(batch.column(1))
            if inner:
                row, node = branch(np.arange(len(held)), batch.column(2).to_numpy().view(np.uint64), held, bound)
            else:
                row, node = first_nodes(held, bound)
            at = batch.column(0).to_numpy()[row]
            made = [pa.array(node.view(np.int64)), pa.array(at), *([batch.column(3).take(pa.array(row))] if inner else [])]
            yield pa.RecordBatch.from_arrays(made, ["node", "class", "top"][:len(made)])

    return rows.mapInArrow(go, "node long, class long" + (", top long" if inner else ""))


def tiles(spark: SparkSession, classes: DataFrame, bound: float) -> DataFrame:
    """(node, class, c): the nodes where the trees end, with the number c of their classes; more than SMALL only at depth DEEP or of KEPT classes."""
    ends, rows = None, _nodes(classes.select("class", "tokens"), bound)
    for depth in range(START, DEEP + 1):
        rows = written(rows, spark, "path-nodes")
        sizes = rows.groupBy("node").agg(F.count("*").alias("c")).where("c > 1")
        rows = rows.join(sizes, "node")
        rows = written(rows if depth > START else rows.withColumn("top", F.col("c")), spark, "path-sizes")  # classes of its first node
        whole = F.lit(depth >= START + 2) & (F.col("c") >= KEPT * F.col("top"))
        ended = F.lit(depth == DEEP) | (F.col("c") <= SMALL) | whole
        done = rows.where(ended).drop("top")
        ends = done if ends is None else ends.unionByName(done)
        more = rows.where(~ended)
        if depth == DEEP or more.isEmpty():
            return ends
        rows = _nodes(more.join(classes.select("class", "tokens"), "class").select("class", "tokens", "node", "top"), bound)


def _agreeing(tile: np.ndarray, n: np.ndarray, held: np.ndarray, root: np.ndarray, guest: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, equal tokens): pairs of rows, sorted by tile, of different roots, whose sizes allow a link and whose tokens agree as often as one may."""
    bound = num / den
    least = bound * TOKENS - MARGIN * (TOKENS * bound * (1 - bound)) ** 0.5
    out = [(np.zeros(0, np.int64),) * 3]
    for k in range(1, len(tile)):
        a = np.flatnonzero(tile[k:] == tile[:-k])
        if not len(a):
            break
        b = a + k
        ok = (root[a] != root[b]) & ~(guest[a] & guest[b]) & (den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b]))
        a, b = a[ok], b[ok]
        equal = (held[a] == held[b]).sum(axis=1)
        ok = equal >= least
        out.append((a[ok], b[ok], equal[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _one_each(a: np.ndarray, b: np.ndarray, equal: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray]:
    """One partner a row: the first of its tile that agrees as the bound asks, else its best."""
    x, y, e = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([equal, equal])
    sure = (e >= enough) & (y < x)
    order = np.lexsort((y, np.where(sure, 0, -e), ~sure, x))
    x, y = x[order], y[order]
    head = np.diff(x, prepend=-1) != 0
    return x[head], y[head]


def _steps(spark: SparkSession, rows: DataFrame, per_step: int) -> DataFrame:
    """Adds step: tiles dealt over as many steps as their rows need; rows is a written table."""
    steps = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // per_step))
    return rows.withColumn("step", F.pmod(F.xxhash64("node", "tile"), F.lit(steps)))


def _sorted_tiles(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows by tile and print, the number of each row's tile, and of its root."""
    table = table.sort_by([("node", "ascending"), ("tile", "ascending"), ("print", "ascending")]).combine_chunks()
    number = lambda c: table.column(c).combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    node, tile = number("node"), table.column("tile").to_numpy()
    new = (np.diff(node, prepend=-1) != 0) | (np.diff(tile, prepend=-1) != 0)
    return table, np.cumsum(new), number("root")


def proposed(spark: SparkSession, spots: DataFrame, classes: DataFrame, num: int, den: int, all_pairs: bool) -> DataFrame:
    """Distinct (a, b), prints with a < b, to confirm: one partner for each class of a tile, or all pairs of different roots.

    spots (node, tile, class), written; classes (class, n, print, tokens, root).
    """
    def compare(table: pa.Table) -> pa.Table:
        table, tile, root = _sorted_tiles(table)
        a, b, equal = _agreeing(tile, table.column("n").to_numpy(), _matrix(table.column("tokens")), root, np.zeros(len(tile), bool), num, den)
        if not all_pairs:
            a, b = _one_each(a, b, equal, num / den * TOKENS)
        names = table.column("print")
        return pa.table({"a": names.take(pa.array(np.minimum(a, b))), "b": names.take(pa.array(np.maximum(a, b)))})

    d = _steps(spark, spots, STEP_ROWS).join(classes, "class").select("step", "node", "tile", "n", "print", "tokens", "root")
    found = d.groupBy("step").applyInArrow(compare, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _linking(a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which pairs of rows have sets (sorted) that link."""
    out = np.zeros(len(a), bool)
    order = np.argsort(b, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(b[order])) + 1) if len(a) else ():
        own, others = sets[b[at[0]]], [sets[i] for i in a[at]]
        sizes = np.array([len(s) for s in others])
        values = np.concatenate(others)
        spot = np.minimum(np.searchsorted(own, values), len(own) - 1)
        over = np.add.reduceat(own[spot] == values, np.cumsum(sizes) - sizes)
        out[at] = den * over >= num * (sizes + len(own) - over)
    return out


def linked_in_hubs(spark: SparkSession, wide: DataFrame, classes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of all pairs of different roots that link, among the classes of large nodes; wide (node, class), classes (class, n, print, tokens, root)."""
    own = wide.join(classes.select("class", "print", "root"), "class")
    most = own.groupBy("node", "root").agg(F.count("*").alias("held")).groupBy("node").agg(
        F.max(F.struct("held", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1").select("node", F.col("m.root").alias("hub"))
    rows = written(own.join(most, "node").select(F.col("hub").alias("node"), "print", "root").distinct(), spark, "path-hubs")
    sizes = rows.groupBy("node").agg(F.ceil(F.count("*") / SMALL).alias("tiles"), F.greatest(F.ceil(F.count_if(F.col("root") != F.col("node")) / GUESTS), F.lit(1)).alias("blocks"))
    rows = rows.join(sizes, "node").withColumns({"tile": F.pmod(F.xxhash64("print"), "tiles"), "block": F.pmod(F.hash("print"), "blocks")})
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    guests = rows.where("root <> node").select("node", "print", "root", "tile", "block", "blocks", each("tiles").alias("to")).where("tile <> to")
    guests = guests.select("node", (F.col("to") * F.col("blocks") + F.col("block")).alias("tile"), "print", "root", F.lit(True).alias("guest"))
    hosts = rows.select("node", "print", "root", "tile", "blocks", each("blocks").alias("block"))  # a tile stands once for each block of guests
    hosts = hosts.select("node", (F.col("tile") * F.col("blocks") + F.col("block")).alias("tile"), "print", "root", F.lit(False).alias("guest"))
    rows = hosts.union(guests)
    rows = written(rows, spark, "path-hub-tiles")

    def compare(table: pa.Table) -> pa.Table:
        table, tile, root = _sorted_tiles(table)
        a, b, _ = _agreeing(tile, table.column("n").to_numpy(), _matrix(table.column("tokens")), root, table.column("guest").to_numpy(), num, den)
        held = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        ok = _linking(a, b, held, num, den)
        names = table.column("print")
        return pa.table({"a": names.take(pa.array(a[ok])), "b": names.take(pa.array(b[ok]))})

    d = _steps(spark, rows, SET_ROWS).join(classes.select("print", "n", "tokens"), "print").join(sets, "print")
    d = d.select("step", "node", "tile", "n", "print", "tokens", "root", "guest", "hashes")
    return d.groupBy("step").applyInArrow(compare, "a binary, b binary").distinct()


def _key(c: str):
    return F.coalesce(F.col(c), F.lit(-(1 << 63)))


def full_sets(spark: SparkSession, docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(print, hashes) of the classes in wanted (low, print), made anew from the texts of their first documents."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, chars=2_000_000):
                sets = shingle_sets([x.as_buffer().to_pybytes() for x in rows.column(1)], width)
                raw = [s.tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in raw], pa.binary()), pa.array(raw, pa.binary())], ["print", "hashes"])

    wanted = written(wanted.select(_key("low").alias("key"), "print"), spark, "path-wanted")
    texts = texts_of(docs).withColumn("key", _key("doc_id"))
    made = texts.join(wanted.select("key").distinct(), "key", "left_semi").select("doc_id", "text").mapInArrow(make, "print binary, hashes binary")
    # an id may stand for several texts, and only one of equal sets is needed
    return written(made.join(wanted.select("print"), "print", "left_semi").dropDuplicates(["print"]), spark, "path-sets")


def confirmed(spark: SparkSession, found: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets link."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            over = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array([den * o >= num * (len(x) + len(y) - o) for o, (x, y) in zip(over, pairs)], pa.bool_()))

    left = sets.select(F.col("print").alias("a"), F.col("hashes").alias("ah"))
    right = sets.select(F.col("print").alias("b"), F.col("hashes").alias("bh"))
    both = found.join(left, "a").join(right, "b").select("a", "b", "ah", "bh")
    return written(both.mapInArrow(check, "a binary, b binary"), spark, "path-links")


def _rooted(classes: DataFrame, root: DataFrame) -> DataFrame:
    return classes.drop("root").join(root.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))


def join(spark: SparkSession, docs: DataFrame, *, width: int = 2, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (whether the row has its component's id)."""
    bound = num / den
    rows = written(signed(docs, width), spark, "path-rows")
    classes = rows.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("low"), F.min(F.struct("n", "tokens")).alias("x"))
    classes = written(classes.select(F.xxhash64("print").alias("class"), "print", "low", "x.n", "x.tokens", F.col("print").alias("root")), spark, "path-classes")
    ends = tiles(spark, classes, bound)
    spots = ends.withColumn("tiles", F.ceil(F.col("c") / SMALL)).withColumn("tile", F.pmod(F.xxhash64("node", "class"), "tiles"))
    spots = written(spots, spark, "path-spots")
    released(spark)
    near = written(proposed(spark, spots, classes, num, den, False), spark, "path-pairs")
    wide = spots.where("tiles > 1").select("node", "class")
    some = near.select(F.col("a").alias("print")).union(near.select("b")).union(wide.join(classes, "class").select("print")).distinct()
    sets = full_sets(spark, docs, classes.join(some, "print", "left_semi"), width)
    released(spark)
    root = written(components(spark, confirmed(spark, near, sets, num, den), "path-comp"), spark, "path-roots")
    grouped = written(_rooted(classes, root), spark, "path-grouped")
    released(spark)
    small = written(spots.where("tiles = 1"), spark, "path-small")
    late = confirmed(spark, written(proposed(spark, small, grouped, num, den, True), spark, "path-pairs"), sets, num, den)
    late = written(late.union(linked_in_hubs(spark, wide, grouped, sets, num, den)), spark, "path-late")
    released(spark)
    if not late.isEmpty():
        root = written(components(spark, root.select(F.col("node").alias("a"), F.col("root").alias("b")).union(late), "path-comp"), spark, "path-roots")

    named = _rooted(classes, root)
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    out = rows.join(named.select("print", "root").join(lows, "root"), "print", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
