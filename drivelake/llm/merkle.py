"""Merkle manifest of a dataset: every row a leaf, a tree per source, a tree over the sources.

Levels are concatenated strings. A block is an aligned run of ``BLOCK`` nodes of
one tree and keeps each of its levels as one hex string: a substring of
``FAN * DIGEST`` characters is a run and hashes to a parent, and what stands to
the left and right of a node within its run are its siblings. The tops of the
blocks are the nodes of the next round, until one is left.

A node's place in its tree comes from a range sort on (tree, id, hash) and the
counts of the sorted pieces, so no tree is held by one task whatever its share
of the rows. Each round holds 1 / ``BLOCK`` of the rows of the one before.

Rows: a leaf is made of doc_id, source, lang, n_chars and text, ``-`` for a null.
Rows of a null source form a tree of their own, which comes first. Null ids come
before all others; rows with one id follow their hashes, equal rows are
interchangeable and each has a place and a proof. A row without an id is never
tampered with. Empty texts and very long ones are leaves as any other; other
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import written

#: Children of a node; levels that a block holds; characters of a digest.
FAN, LEVELS, DIGEST = 16, 3, 64
BLOCK = FAN ** LEVELS
#: Characters of a run.
RUN = FAN * DIGEST
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256 over the columns in order, each ``-`` if null, else its length in bytes, ``:`` and its value."""
    held = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in held]), 256)


def lowered(text: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, id, node, tampered): the leaf of every row, and the one it has with a lower-cased text where 5 divides the CRC-32 of its id."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    d = docs.select(*[(F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = leaf_hash([F.col(c) for c in FIELDS[:-1]] + [lowered(F.col("text"))])
    return d.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree"), F.col("doc_id").alias("id"),
                    leaf_hash([F.col(c) for c in FIELDS]).alias("node"), F.when(hit, changed).alias("tampered"))


def placed(spark: SparkSession, nodes: DataFrame, by: list[str]) -> DataFrame:
    """Adds place (from 0) and n, the number of nodes in the tree. Equal rows are dealt by their place in the input, so none makes a piece too large."""
    dealt = written(nodes.withColumn("salt", F.monotonically_increasing_id()), spark, "merkle-nodes")
    order = ["tree", *by, "salt"]
    rows = written(dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt").withColumn("at", F.monotonically_increasing_id()), spark, "merkle-sorted")
    rows = rows.withColumn("piece", F.shiftright("at", 33))  # the upper bits are the number of the sorted piece
    pieces = rows.groupBy("tree", "piece").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    before = W.partitionBy("tree").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select("tree", "piece", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"),
                           F.sum("c").over(W.partitionBy("tree")).alias("n"))
    return rows.join(pieces, ["tree", "piece"]).withColumn("place", F.col("before") + F.col("at") - F.col("first")).drop("piece", "at", "first", "before")


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def blocks(nodes: DataFrame) -> DataFrame:
    """(tree, block, n, xs, level0..level2, top): the nodes of each aligned block in order, its levels as strings, and its own digest.

    Nodes are hashed as long as their tree holds more than one on the level.
    """
    kept = [c for c in nodes.columns if c not in ("tree", "n", "place", "node")]
    made = nodes.groupBy("tree", "n", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node", *kept))).alias("xs"))  # BLOCK nodes at most
    made = made.withColumn("level0", F.array_join(F.transform("xs", lambda x: x["node"]), ""))
    for k in range(1, LEVELS + 1):
        made = made.withColumn(f"level{k}", F.when(F.col("n") > FAN ** (k - 1), _parents(F.col(f"level{k - 1}"))))
    top = F.coalesce(*[F.col(f"level{k}") for k in range(LEVELS, -1, -1)])
    return made.withColumn("top", top).drop(f"level{LEVELS}")


def grown(spark: SparkSession, nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, and (tree, top) with the last digest of each tree."""
    rounds, tops = [], None
    while True:
        made = written(blocks(nodes), spark, "merkle-blocks")
        rounds.append(made)
        done = made.where(F.col("n") <= BLOCK).select("tree", "top")
        tops = done if tops is None else tops.union(done)
        more = made.where(F.col("n") > BLOCK)
        if more.isEmpty():
            return rounds, tops
        nodes = more.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"))


def _flanks(level: Column, k: Column) -> Column:
    """The siblings of node k on a level, left and right of it within its run."""
    run = F.floor(k / FAN).cast("int")
    left = F.substr(level, run * RUN + 1, (k - run * FAN) * DIGEST)
    right = F.substr(level, (k + 1) * DIGEST + 1, (run * FAN + FAN - 1 - k) * DIGEST)
    return F.struct(left.alias("left"), right.alias("right"))


def nodes_with_paths(made: DataFrame, tails: DataFrame) -> DataFrame:
    """All nodes of some blocks with what they carry and path, their siblings level by level; tails has (tree, block, path, ..) above the blocks."""
    n, none = F.col("n"), F.array().cast(_PATH)

    def run(r: Column) -> Column:
        above = F.when(n > FAN ** 2, F.array(_flanks(F.col("level1"), r), _flanks(F.col("level2"), F.floor(r / FAN).cast("int"))))
        above = above.when(n > FAN, F.array(_flanks(F.col("level1"), r))).otherwise(none)
        return F.struct(F.substr(F.col("level0"), r * RUN + 1, F.lit(RUN)).alias("nodes"), F.slice("xs", r * FAN + 1, FAN).alias("xs"), above.alias("above"))

    extra = [c for c in tails.columns if c not in ("tree", "block", "path")]
    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size("xs") / FAN).cast("int") - 1), run)
    d = made.join(tails, ["tree", "block"]).select("tree", "n", "path", *extra, F.explode(runs).alias("run"))  # each run reads the long strings once
    d = d.select("tree", "n", "path", *extra, F.col("run.nodes").alias("nodes"), F.col("run.above").alias("above"), F.posexplode("run.xs").alias("k", "x"))
    own = F.when(n > 1, F.array(_flanks(F.col("nodes"), F.col("k")))).otherwise(none)
    return d.select("tree", *extra, "x.*", F.concat(own, "above", "path").alias("path"))


def climbed(spark: SparkSession, rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round with paths to the top; above has (tree, path, ..) from the tree's last digest on."""
    tails = None
    for i, made in reversed(list(enumerate(rounds))):
        last = made.where(F.col("n") <= BLOCK).select("tree", "block").join(above, "tree")
        tails = last if tails is None else tails.unionByName(last)
        nodes = nodes_with_paths(made, tails)
        if i:
            tails = written(nodes.drop("node").withColumnRenamed("place", "block"), spark, "merkle-paths")
    return nodes


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with its siblings."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, path (siblings level by level) and tampered (the changed leaf, null where unchanged)."""
    rounds, tops = grown(spark, placed(spark, leaves(docs), ["id", "node"]))
    subroots = tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("top").alias("node"))
    upper, one = grown(spark, placed(spark, subroots, ["source"]))
    root = one.select("top").first()  # a single digest
    start = spark.createDataFrame([("",)], "tree string").select("tree", F.array().cast(_PATH).alias("path"))
    over = climbed(spark, upper, start).select(F.col("source").alias("tree"), F.col("node").alias("subroot"), "path")
    found = climbed(spark, rounds, written(over, spark, "merkle-sources"))
    return found.select(F.col("id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", F.lit(root and root["top"]).cast("string").alias("root"), "path", "tampered")


def verification(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The manifest with a digest of each proof, the root folded from the tampered leaf (else its own) and whether it is the dataset's root."""
    d = manifest(spark, docs)
    d = d.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    return d.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
