"""Audit of filters that interact: what each of five filters removes, in every order they can be applied in.

A document fails a set of filters, its mask. In an order, it goes at the first
filter of its mask, so for a mask and a prefix of other filters followed by one
of the mask, all orders that begin this way remove the document at that step.
In lexicographic order of the permutations (by their Lehmer code) these orders
are one interval. So per part and step a difference array over the 120 ranks is
enough: the counts of a mask are added at the start of each of its intervals and
taken away past its end, and prefix sums give what every order removes there.

Documents become counts by part and mask before anything else; the intervals
come from the Lehmer code alone (a fixed table of some thousand rows).

Rows: a null text is the empty text, which has no words and fails A alone, unless
a smaller id has an empty text too. A null source is the part ``''``. A row
without an id has no label, fails E never, and makes no other row fail it; rows with one
id and text do not fail E by each other. Of repeated labels of an id the largest count.
An empty table gives no parts, so no rows. Other columns are left out.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import written

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
#: Words at least; percent of distinct words at least; percent of capitals at most.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5
_SPACES, _MARKS = "[ \\t-\\r]+", "[#$%&*|]"


def order_of(rank: int) -> str:
    """The permutation with that lexicographic rank, from its Lehmer code."""
    left, out = list(FILTERS), []
    for k in range(len(FILTERS) - 1, -1, -1):
        digit, rank = divmod(rank, factorial(k))
        out.append(left.pop(digit))
    return "".join(out)


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank past the last) of all orders, by the step at which a document of the mask goes."""
    out = []

    def descend(left: list[int], rank: int) -> None:
        width = factorial(len(left) - 1)
        for digit, f in enumerate(left):
            first = rank + digit * width
            if mask >> f & 1:
                out.append((len(FILTERS) - len(left) + 1, first, first + width))
            elif len(left) > 1:
                descend(left[:digit] + left[digit + 1:], first)

    descend(list(range(len(FILTERS))), 0)
    return out


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, blob, mask): blob is the SHA-256 of the text; bits 0 to 3 of mask are the filters A to D."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", _SPACES), ""))
    n, bit = F.size("words"), lambda fails, k: F.when(fails, 1 << k).otherwise(0)
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    mask = (bit(n < MIN_WORDS, 0) + bit(100 * F.size(F.array_distinct("words")).cast("long") < MIN_DISTINCT * n, 1)
            + bit(100 * capitals.cast("long") > MAX_CAPITALS * F.length("text"), 2) + bit(F.col("text").rlike(_MARKS), 3))
    return d.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("blob"), mask.alias("mask"))


def counts(docs: DataFrame, labels: DataFrame, spark: SparkSession) -> DataFrame:
    """(part, mask, n, good, toxic): documents by what they fail, bit 4 being filter E."""
    rows = written(masks(docs), spark, "audit-masks")
    again = rows.groupBy("blob").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).where("c > 1 and first is not null").select("blob", "first")
    is_one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    d = rows.join(again, "blob", "left").join(known, "doc_id", "left")
    e = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return d.groupBy("part", (F.col("mask") + e).alias("mask")).agg(F.count("*").alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


def _steps(spark: SparkSession) -> DataFrame:
    """(mask, step, at, sign): both ends of all intervals of all masks that fail anything."""
    rows = [(m, s, at, sign) for m in range(1, 1 << len(FILTERS)) for s, lo, hi in intervals(m) for at, sign in ((lo, 1), (hi, -1)) if at < ORDERS]
    return spark.createDataFrame(rows, "mask int, step int, at int, sign int")


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    found = written(counts(docs, labels, spark), spark, "audit-counts")
    ends = found.join(F.broadcast(_steps(spark)), "mask")  # a fixed table
    value = lambda c: (F.col(c) * F.col("sign")).alias(c)
    ends = ends.select("part", "step", "at", value("n"), value("good"), value("toxic"))
    zero = F.lit(0).cast("long")
    grid = found.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("at"), *[zero.alias(c) for c in ("n", "good", "toxic")])
    ends = ends.union(grid).groupBy("part", "step", "at").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])

    letter: Column = F.substr(F.element_at(F.array(*[F.lit(order_of(r)) for r in range(ORDERS)]), F.col("at") + 1), F.col("step"), F.lit(1))
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << k) > 0, F.col("n")).otherwise(0)) for k in range(len(FILTERS))]
    alone = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(len(FILTERS))]
    parts = found.groupBy("part").agg(F.sum("n").alias("docs"), F.array(*failing).alias("failing"), F.array(*alone).alias("alone"))
    ranks = W.partitionBy("part", "step").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    d = ends.select("part", "step", "at", *[F.sum(c).over(ranks).cast("long").alias(c) for c in ("n", "good", "toxic")])
    d = d.join(parts, "part").withColumn("letter", letter)
    so_far = W.partitionBy("part", "at").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    which = F.ascii("letter") - F.lit(ord(FILTERS[0]) - 1)
    d = d.withColumns({"gone": F.sum("n").over(so_far), "shapley": F.sum("n").over(W.partitionBy("part", "letter")),
                       "order": F.element_at(F.array(*[F.lit(order_of(r)) for r in range(ORDERS)]), F.col("at") + 1)})
    return d.select("part", F.col("order").alias("filter_order"), "step", (F.col("docs") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
                    (F.element_at("failing", which) - F.col("n")).alias("redundant"), F.element_at("alone", which).alias("unique_fails"),
                    F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
