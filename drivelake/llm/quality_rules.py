"""Quality rules: histograms of a document against those of its language, by Jensen-Shannon distance.

Two histograms are compared: the characters of a text over classes, and its
words over the common words of its language with one bin for all others. The
references come from all documents of a language that pass the base rules: for
the classes the median share of each, so that a tenth of junk does not shift
them, for the words their sums over the documents. The common words are the
language's ``COMMON`` most frequent ones. A language with less than ``LEAST``
documents that pass the base rules has no reference: its documents, like those
without a language, get no distance and are kept if they pass the base rules.
Texts under ``MIN_WORDS`` words, or a reference without words, are too little to
judge a distance by.

DataFrame operations only. Per-document histograms are written to the shared
folder once, as both the references and the distances need them.

Rows: a null text has no words and fails the base; a null doc_id or language
stays null; repeated rows are judged each by itself; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import written

#: Base rules: words at least; percent of words in repeated windows at most.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Common words of a language; least number of documents for a reference.
COMMON, LEAST = 64, 30
#: Largest distances (square root of the divergence in bits, 0 to 1) of a kept document.
MAX_CLASSES, MAX_COMMON = 0.38, 0.50
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "symbol", "rest")
_SPACES = "[ \\t-\\r]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def _without(text: str, pattern: str) -> Column:
    """Number of characters that the pattern takes away from a column."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def common_words(docs: DataFrame, count: int = COMMON, least: int = LEAST) -> DataFrame:
    """(ref, common, pattern): the most frequent words (lower case) of each language with that many rows, and a pattern that finds them as whole words."""
    rows = docs.where("lang is not null").select("lang", F.explode(_words(F.lower("text"))).alias("word")).groupBy("lang", "word").count()
    best = rows.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("count"), "word"))).where(F.col("at") <= count)
    many = docs.groupBy("lang").count().where(F.col("count") >= least).select("lang")
    best = best.join(many, "lang", "left_semi")
    plain = lambda c: F.regexp_replace(c, "([^\\p{L}\\p{N}])", "\\\\$1")
    # words of one first letter are one branch, so a word is held against few
    branches = best.groupBy("lang", F.substring("word", 1, 1).alias("head")).agg(F.collect_list("word").alias("words"), F.collect_list(F.expr("substring(word, 2)")).alias("rest"))
    branches = branches.select("lang", "words", F.concat(plain(F.col("head")), F.lit("(?:"), F.array_join(F.transform("rest", plain), "|"), F.lit(")")).alias("branch"))
    ends = F.lit("(?<![^ \\t-\\r])(?:"), F.lit(")(?![^ \\t-\\r])")
    return branches.groupBy(F.col("lang").alias("ref")).agg(F.flatten(F.collect_list("words")).alias("common"),
                                                            F.concat(ends[0], F.array_join(F.collect_list("branch"), "|"), ends[1]).alias("pattern"))


def features(docs: DataFrame, common: DataFrame) -> DataFrame:
    """Adds n_words, the base counts, base_failed, classes (a count per class) and words (word and count of each common word of its language)."""
    text = F.col("text")
    d = docs.join(F.broadcast(common), F.col("lang") == F.col("ref"), "left")  # a row of common words a language
    d = d.withColumns({"w": _words(text), "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))})
    n = F.size("w")
    windows = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    # classes but the first are counted in what the first leaves, which is little of most texts
    d = d.withColumn("left", F.regexp_replace(text, "[a-z]+", ""))
    d = d.withColumns({
        "n_words": n.cast("long"), "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_symbols": _without("left", "[#*$%&|<>]+"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": F.slice(windows, 1, F.greatest(n - 2, F.lit(0))),
        "hits": F.coalesce(F.sort_array(F.regexp_extract_all(F.lower("text"), F.col("pattern"), F.lit(0))), F.array().cast("array<string>")),
        "lower": (F.length(text) - F.length("left")).cast("long"), "upper": _without("left", "[A-Z]+"), "digit": _without("left", "[0-9]+"), "other_letter": _without("left", "[^\\x00-\\x7F]+")})
    # only a text with equal windows needs their order
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    d = d.withColumn("windows", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).otherwise(none))
    twice = F.filter("windows", lambda x, i: (F.get("windows", i - 1)["h"] == x["h"]) | (F.get("windows", i + 1)["h"] == x["h"]))
    d = d.withColumns({"at": F.sort_array(F.transform(twice, lambda x: x["i"])), "hit": F.array_distinct("hits")})
    gaps = F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1), lambda a, b: F.least(b - a, F.lit(3)))
    d = d.withColumns({"n_repeat_words": F.when(F.size("at") == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda a, b: a + b)).cast("long"),
                       "starts": F.transform("hit", lambda x: F.array_position("hits", x))})
    counts = F.transform("hit", lambda x, i: F.struct(x.alias("word"), (F.coalesce(F.get("starts", i + 1), F.size("hits") + F.lit(1).cast("long")) - F.get("starts", i)).alias("n")))
    space = (F.length(text) - F.col("word_chars")).cast("long")
    rest = F.length(text) - F.col("lower") - F.col("upper") - F.col("other_letter") - F.col("digit") - space - F.col("n_symbols")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return d.withColumns({"base_failed": failed, "words": counts,
                          "classes": F.array(*[F.col(c) for c in CLASSES[:4]], space, F.col("n_symbols"), rest.cast("long"))}
                         ).drop("w", "lines", "left", "hashes", "windows", "pattern", "hits", "hit", "at", "starts", "ref", "common", *CLASSES[:4])


def references(found: DataFrame, common: DataFrame, least: int = LEAST) -> DataFrame:
    """(ref, q, qw, q_other) per language: shares of the classes, of the common words, and of the other words."""
    base = found.where(~F.col("base_failed") & F.col("lang").isNotNull())
    length = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    medians = [F.percentile_approx(F.get("classes", i) / length, 0.5, 10_000).alias(c) for i, c in enumerate(CLASSES)]
    shares = base.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"), *medians).where(F.col("docs") >= least)
    counted = base.select("lang", F.explode("words").alias("x")).groupBy("lang", "x.word").agg(F.sum("x.n").alias("n"))
    counted = counted.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("seen"))
    d = shares.join(common, F.col("lang") == F.col("ref")).join(counted, "lang", "left")
    zero = F.lit(0.0)
    d = d.withColumns({"q": F.array(*[F.coalesce(c, zero) for c in CLASSES]),
                       "own": F.transform("common", lambda w: F.coalesce(F.element_at("seen", w), F.lit(0)) / F.col("words"))})
    total = F.greatest(F.aggregate("q", zero, lambda a, b: a + b), F.lit(1e-9))
    return d.select("ref", F.transform("q", lambda x: x / total).alias("q"), F.map_from_arrays("common", "own").alias("qw"),
                    (1 - F.aggregate("own", zero, lambda a, b: a + b)).alias("q_other"))


def _part(p: Column, q: Column) -> Column:
    """One bin's part of the divergence in bits."""
    half = lambda a, b: F.when(a > 0, a / 2 * F.log2(2 * a / (a + b))).otherwise(0.0)
    return half(p, q) + half(q, p)


def judged(found: DataFrame, refs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds class_distance, common_distance (null where there is too little to judge by) and kept."""
    d = found.join(F.broadcast(refs), F.col("lang") == F.col("ref"), "left")  # a row a language
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    p = F.transform("classes", lambda c: c / F.col("chars"))
    d = d.withColumn("chars", chars)
    zero = F.lit(0.0)
    of_class = F.aggregate(F.zip_with(p, "q", _part), zero, lambda a, b: a + b)
    own = F.filter("words", lambda x: F.element_at("qw", x["word"]).isNotNull())
    d = d.withColumn("own", F.transform(own, lambda x: F.struct((x["n"] / F.col("n_words")).alias("p"), F.element_at("qw", x["word"]).alias("q"))))
    p_seen = F.aggregate("own", zero, lambda a, b: a + b["p"])
    q_seen = F.aggregate("own", zero, lambda a, b: a + b["q"])
    seen = F.aggregate(F.transform("own", lambda x: _part(x["p"], x["q"])), zero, lambda a, b: a + b)
    unseen = F.greatest(1 - F.col("q_other") - q_seen, zero) / 2
    of_word = seen + unseen + _part(F.greatest(1 - p_seen, zero), F.greatest(F.col("q_other"), zero))
    enough = (F.col("n_words") >= min_words) & F.col("ref_chars")
    d = d.withColumn("ref_chars", F.coalesce(F.aggregate("q", zero, lambda a, b: a + b) > 0, F.lit(False)))
    d = d.withColumns({"class_distance": F.when(enough, F.sqrt(F.greatest(of_class, zero))), "common_distance": F.when(enough, F.sqrt(F.greatest(of_word, zero)))})
    near = (F.coalesce("class_distance", zero) <= MAX_CLASSES) & (F.coalesce("common_distance", zero) <= MAX_COMMON)
    return d.withColumn("kept", ~F.col("base_failed") & near).drop("ref", "q", "qw", "q_other", "chars", "own", "ref_chars")


def assess(spark: SparkSession, docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, lang, the counts, base_failed, distances and kept; with carry also row, all columns as they came."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                      (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang"),
                      *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    common = written(common_words(own.select("lang", "text")), spark, "quality-words")
    found = written(features(own, common).drop("text"), spark, "quality")
    return judged(found, written(references(found, common), spark, "quality-references"))


def kept(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return assess(spark, docs, carry=True).where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
