"""Personal data, and the terms that give it away: information-theoretic sanitisation.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers found in the texts. For every word of the texts that hold an entity e the
corpus tells how strongly it reveals e: with N documents, df(t) of them holding
the word, df(e) the entity and df(t, e) both, at any distance,

    PMI(t; e) = log2(N df(t, e) / (df(t) df(e)))   of   IC(e) = log2(N / df(e)).

A word with PMI >= ``DISCLOSED`` * IC for any entity discloses it, and is a span
of kind "term" at all its places in all texts, those without the entity
included. Counts are of distinct texts, so copies add nothing. A small df(t, e)
says more than it should, so PMI is taken of its held-out value: ``ONCE`` for
one text, df - ``DISCOUNT`` from two on. For a word and an entity of one text the
share is then 1 - log2(1 / ``ONCE``) / log2(N), and corpora of under 212 texts
are too small to tell. Sanitised text has entities generalised to their kind, such
words generalised to [NAME] if capitalised and removed otherwise.

PMI depends on the counts alone, so words of the same texts are one class, and
entities likewise (the texts as a count and an exclusive or of their hashes):
pairs are made of the classes of a text, not of its words and entities. As
df(t, e) <= df(e), a word of more than df(e) ** D * N ** (1 - D) texts, D being
``DISCLOSED``, cannot disclose e and makes no pair.

Texts that may hold a disclosing word are found by a bitmap of ``BITS`` bits, a
table of at most ``BITS`` / 64 rows, before the exact join, so only they move.

DataFrame operations only. Counts cover all distinct texts.

Rows: a null text is the empty text; a null doc_id stays null; repeated rows
give repeated results and count as one text; an empty table gives none.
Spans count code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.llm.common import released, written
from drivelake.llm.spans import SPAN, joined, places

KINDS = ("email", "ip", "card", "phone")
DISCLOSED, LETTERS = 0.85, 3
#: Bits of the bitmaps by which rows are chosen before a join.
BITS = 1 << 23
#: What is expected in fresh text of a pair counted once (held-out value of Church and Gale, 1991), and how much less than its count of one counted more often.
ONCE, DISCOUNT = 0.448, 0.75
#: The patterns of the base. Possessive, as nothing they pass over could match in part; a run of
#: local-part characters is tried from its start only (or where the last match ended).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_WORD = r"\p{L}{%d,}+" % LETTERS


def _ip(hit: Column) -> Column:
    def small(part):
        digits = F.regexp_replace(part, "^0+", "")
        return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(hit, r"\."), small)


def _card(hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)

    def value(d, i):
        x = F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    luhn = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b) % 10 == 0
    return F.when(n.between(14, 19), luhn).otherwise(F.lit(False))


def _phone(hit: Column) -> Column:
    return F.length(F.regexp_replace(hit, "[^0-9]", "")).between(10, 15)


_KEEP = {"email": None, "ip": _ip, "card": _card, "phone": _phone}


def with_spans(docs: DataFrame) -> DataFrame:
    """Adds base: the spans of the base kinds, by start, then kind."""
    text = F.col("text")
    cut, hits = {}, {}
    for k, p in PATTERNS.items():
        may = text.contains(_HINT[k]) if _HINT[k] else text.rlike("[0-9][0-9 -]{12}")
        cut[f"cut_{k}"] = F.when(may, F.split(text, p, -1))
        hits[f"hit_{k}"] = F.when(F.size(f"cut_{k}") > 1, F.regexp_extract_all(text, F.lit(p), F.lit(0)))
    d = docs.withColumns(cut).withColumns(hits)
    none = F.array().cast(f"array<{SPAN}>")
    found = [F.when(F.col(f"hit_{k}").isNotNull(), places(F.col(f"cut_{k}"), F.col(f"hit_{k}"), i, k, _KEEP[k])).otherwise(none) for i, k in enumerate(KINDS)]
    return d.withColumn("base", F.sort_array(F.concat(*found))).drop(*cut, *hits)


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= LETTERS))


def _place(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(BITS - 1)


def bitmap(keys: DataFrame, column: str) -> DataFrame:
    """(slot, mask): bit k of the mask of slot i is set where a key hashes to 64 i + k."""
    d = keys.select(_place(F.col(column)).alias("h"))
    return d.groupBy(F.shiftright("h", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("mask"))


def _maybe(rows: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The rows whose key may be in the bitmap; it has BITS / 64 rows at most, whatever the data, so it is broadcast."""
    d = rows.withColumn("h", _place(F.col(column))).withColumn("slot", F.shiftright("h", 6)).join(F.broadcast(bits), "slot")
    return d.where(F.expr("(mask & shiftleft(1L, cast(h & 63 as int))) <> 0")).drop("h", "slot", "mask")


def disclosing(spark: SparkSession, texts: DataFrame, found: DataFrame) -> DataFrame:
    """(term, df, inside): the words that disclose some entity, how many texts hold them, and how many of these hold any entity.

    texts (text) are all texts; found (text_id, text, base) the rows with their base spans.
    """
    n = float(max(found.select("text_id").distinct().count(), 1))
    df_word = texts.distinct().select(F.explode(_distinct_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    once = found.where(F.size("base") > 0).dropDuplicates(["text_id"])
    mark = F.xxhash64("text_id")
    own = F.transform("base", lambda e: F.struct(e["kind"].alias("kind"), F.lower(e["value"]).alias("entity")))
    entities = once.select("text_id", F.explode(F.array_distinct(own)).alias("e"))
    classes = entities.groupBy("e").agg(F.count("*").alias("held"), F.bit_xor(mark).alias("ex"))
    classes = written(entities.join(classes, "e").select("text_id", "held", "ex").distinct(), spark, "pii-entities")

    words = written(once.select("text_id", F.explode(_distinct_words(F.col("text"))).alias("term")), spark, "pii-words")
    counts = words.groupBy("term").agg(F.count("*").alias("inside"), F.bit_xor(mark).alias("wx")).join(df_word, "term")
    # a word of a text is among the words of the distinct texts; greatest() guards odd case mappings
    counts = written(counts.withColumn("df", F.greatest("df", "inside")), spark, "pii-counts")
    released(spark)
    most = classes.groupBy("text_id").agg(F.max("held").alias("most"))
    rare = words.join(counts, "term").join(most, "text_id").where(F.col("df") <= F.pow("most", F.lit(DISCLOSED)) * n ** (1 - DISCLOSED) * (1 + 1e-9))
    rare = rare.select("text_id", "df", "inside", "wx").distinct()
    both = rare.join(classes, "text_id").groupBy("held", "ex", "df", "inside", "wx").agg(F.count("*").alias("both"))
    expected = F.when(F.col("both") == 1, F.lit(ONCE)).otherwise(F.col("both") - DISCOUNT)
    pmi = F.log2(n * expected / (F.col("df") * F.col("held")))
    ic = F.log2(n / F.col("held"))
    told = both.where((ic > 0) & (pmi >= DISCLOSED * ic)).select("df", "inside", "wx").distinct()
    return counts.join(told, ["df", "inside", "wx"], "left_semi").select("term", "df", "inside")


def marked(spark: SparkSession, texts: DataFrame, told: DataFrame) -> DataFrame:
    """(text_id, all): the places of disclosing words in each distinct text that holds any; texts (text_id, text)."""
    words = texts.select("text_id", F.explode(_distinct_words(F.col("text"))).alias("term"))
    # an inner join, as the optimizer would put a semi join before the bitmap; told has each term once
    hits = _maybe(words, "term", bitmap(told, "term")).join(told.select("term"), "term")
    hits = written(hits.groupBy("text_id").agg(F.collect_set("term").alias("told")), spark, "pii-hits")
    some = _maybe(texts, "text_id", bitmap(hits, "text_id")).join(hits, "text_id").dropDuplicates(["text_id"])
    here = places(F.split("text", _WORD, -1), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), len(KINDS), "term", lambda w: F.array_contains("told", F.lower(w)))
    return some.select("text_id", here.alias("all"))


def find(spark: SparkSession, docs: DataFrame, carry: bool = False) -> DataFrame:
    """Per document: doc_id, base (spans), terms (spans); with carry also row, all columns as they came."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                      *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    text_id = F.unhex(F.sha2("text", 256)).alias("text_id")
    found = with_spans(own).select("*", text_id)
    keep = F.when(F.size("base") > 0, F.col("text"))  # only these texts are read again from here
    found = written(found.withColumn("text", keep), spark, "pii")
    told = written(disclosing(spark, own.select("text"), found), spark, "pii-terms")
    released(spark)
    terms = written(marked(spark, own.select(text_id, "text"), told), spark, "pii-spans")
    released(spark)
    d = found.drop("text").join(terms, "text_id", "left").drop("text_id")
    free = F.filter("all", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return d.withColumn("terms", F.coalesce(free, F.array().cast(f"array<{SPAN}>"))).drop("all")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def findings(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans (base and terms, by start, then kind)."""
    d = find(spark, docs)
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined(F.sort_array(F.concat("base", "terms"))).alias("spans"))


def sanitised(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with entities generalised and disclosing words generalised or removed; other columns stay."""
    d = find(spark, docs, carry=True)
    text = F.col("row")["text"]

    def step(state, s):
        """Text so far and its end; a span that begins before that end is part of the last one."""
        name = F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(F.substring(s["value"], 1, 1) != F.lower(F.substring(s["value"], 1, 1)), "[NAME]").otherwise("")
        more = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), name)
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], more).otherwise(state["out"]).alias("out"))

    done = F.aggregate(F.sort_array(F.concat("base", "terms")), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    changed = F.when(text.isNotNull(), done)
    return d.withColumn("changed", changed).select(*[(F.col("changed") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
