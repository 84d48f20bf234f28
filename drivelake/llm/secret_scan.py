"""Secret scans over a ledger of blobs.

Every version of a text is a blob named by the SHA-256 of its content; a path
(a document) points to one. The ledger holds, per blob, the rules (with their
versions) that have scanned it and what they found. A scan takes only the blobs
and rules that the ledger lacks together, each blob from one of its paths, adds
its rows to the ledger, and joins the findings back to all paths. A new rule
version scans every blob again for that rule alone.

The ledger is an append-only Parquet table in a folder that all executors
share. Rows appear when a scan's job commits; scanning a blob twice (two scans
at once) adds equal rows, which reading folds.

Rows: a null text is the empty text, which is a blob without findings; a null
doc_id is a path like any other; repeated rows give repeated results. Empty
tables give none. Spans count code points, end exclusive; matches of one rule
do not overlap, those of different rules may.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.llm.common import slices, texts_of

#: Kinds of the base, in their order.
BASE = ("assign", "access", "hex")


def _found(pattern: str, keep: Callable[[re.Match], bool] | None = None, hints: tuple[str, ...] = (), flags: int = re.ASCII):
    """Matcher of one rule; texts with none of the hints (lower case) cannot match."""
    compiled = re.compile(pattern, flags)

    def run(text: str, lower: str) -> list[tuple[int, int]]:
        if hints and not any(h in lower for h in hints):
            return []
        return [m.span() for m in compiled.finditer(text) if keep is None or keep(m)]

    return run


#: Rule and version -> matcher, in the order of kinds. A changed rule takes a new version.
RULES: dict[str, Callable[[str, str], list[tuple[int, int]]]] = {
    "assign@1": _found(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                       lambda m: len(m[2]) >= 6, ("passw", "secret", "token", "api"), re.ASCII | re.IGNORECASE),
    "access@1": _found(r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20, ("akia",)),
    "hex@1": _found(r"[0-9a-f]{24,}"),
    "pem@1": _found(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?", None, ("private key",)),
    "jwt@1": _found(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", None, ("eyj",)),
    "forge@1": _found(r"\bgh[opsur]_[A-Za-z0-9]{36,}", None, ("ghp_", "gho_", "ghs_", "ghu_", "ghr_")),
}

_FINDINGS = "array<struct<rule:string,start:int,`end`:int>>"
_LEDGER = f"blob string, rules array<string>, findings {_FINDINGS}"


def versions(docs: DataFrame) -> DataFrame:
    """(doc_id, text, blob)."""
    return texts_of(docs).withColumn("blob", F.sha2(F.col("text"), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(blob, rules, findings), a row per blob; no rows before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/scans")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _LEDGER)
    rows = spark.read.schema(_LEDGER).parquet(f"{ledger}/scans").dropDuplicates()
    return rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
                                    F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))


def pending(paths: DataFrame, ledger: DataFrame, rules: list[str]) -> DataFrame:
    """(blob, path, todo): blobs with rules that have not scanned them, and one path to read each from."""
    wanted = F.array(*map(F.lit, sorted(rules)))
    blobs = paths.groupBy("blob").agg(F.min(F.coalesce("doc_id", F.lit(-1 << 63))).alias("path"))
    todo = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
    return blobs.join(ledger.select("blob", "rules"), "blob", "left").select("blob", "path", todo.alias("todo")).where(F.size("todo") > 0)


def scan(spark: SparkSession, docs: DataFrame, ledger: str, rules: dict | None = None) -> None:
    """Bring the ledger up to date with these documents under these rules."""
    chosen = list(rules if rules is not None else RULES)
    found = versions(docs).withColumn("path", F.coalesce("doc_id", F.lit(-1 << 63)))
    todo = pending(found.select("doc_id", "blob"), read_ledger(spark, ledger), chosen)
    matchers = rules if rules is not None else None

    def run(batches):
        own = matchers if matchers is not None else RULES
        last = None
        for batch in batches:
            for part in slices(batch):
                out = []
                for blob, text, names in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if blob == last:  # copies of one row stand together after the join
                        continue
                    last = blob
                    lower = text.lower()
                    out.append({"blob": blob, "rules": names,
                                "findings": [{"rule": r, "start": a, "end": b} for r in names for a, b in own[r](text, lower)]})
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    rows = found.join(todo, ["blob", "path"]).select("blob", "text", "todo")
    rows.mapInArrow(run, _LEDGER).write.mode("append").option("compression", "zstd").parquet(f"{ledger}/scans")


_ARROW = pa.schema([("blob", pa.string()), ("rules", pa.list_(pa.string())),
                    ("findings", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])


def blob_findings(spark: SparkSession, ledger: str, rules: list[str] | None = None) -> DataFrame:
    """(blob, found): found has (start, rank, kind, end) of these rules, by start, then kind."""
    order = {r: i for i, r in enumerate(rules if rules is not None else RULES)}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    own = F.filter("findings", lambda f: f["rule"].isin(list(order)))
    rows = F.transform(own, lambda f: F.struct(f["start"].alias("start"), rank[f["rule"]].alias("rank"),
                                               F.split(f["rule"], "@")[0].alias("kind"), f["end"].alias("end")))
    return read_ledger(spark, ledger).select("blob", F.sort_array(rows).alias("found"))


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def _of_kind(kind: str):
    return lambda f: f["kind"] == kind


def findings(spark: SparkSession, docs: DataFrame, ledger: str, rules: list[str] | None = None) -> DataFrame:
    """Per path: doc_id, blob, n_<base kind>, base_sha256, spans."""
    found = blob_findings(spark, ledger, rules)
    base = F.filter("found", lambda f: f["kind"].isin(*BASE))
    counts = [F.size(F.filter("found", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    rows = found.where(F.size("found") > 0).select("blob", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
    paths = versions(docs).select("doc_id", "blob")
    none = F.sha2(F.lit(""), 256)
    return paths.join(rows, "blob", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), "blob")


def redacted(spark: SparkSession, docs: DataFrame, ledger: str, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with every finding replaced by [kind]; texts without findings, and all other columns, stay as they are.

    Findings that overlap are replaced together, under the kind of the first.
    chars_col, where the table has it, gets the new length of a changed text.
    """
    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn(
        "blob", F.sha2(F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")), 256))
    found = blob_findings(spark, ledger).where(F.size("found") > 0)

    def step(state, f):
        """Close the last span unless f begins inside it."""
        last = F.element_at(state, -1)
        return F.when((F.size(state) > 0) & (f["start"] < last["end"]),
                      F.concat(F.slice(state, 1, F.size(state) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], f["end"]).alias("end"), last["kind"].alias("kind"))))
                      ).otherwise(F.concat(state, F.array(F.struct(f["start"].alias("start"), f["end"].alias("end"), f["kind"].alias("kind")))))

    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    merged = found.select("blob", F.aggregate("found", empty, step).alias("cuts"))
    text = F.col("row")[text_col]
    kept = F.transform("cuts", lambda c, i: F.concat(
        F.substring(text, F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["end"]) + 1, c["start"] - F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["end"])),
        F.lit("["), c["kind"], F.lit("]")))
    tail = F.substring(text, F.element_at("cuts", -1)["end"] + 1, F.length(text))
    changed = F.when(F.col("cuts").isNotNull(), F.concat(F.array_join(kept, ""), tail)).otherwise(text)
    out = own.join(merged, "blob", "left").select("row", "cuts", changed.alias("changed"))
    cols = []
    for c in names:
        if c == text_col:
            cols.append(F.col("changed").alias(c))
        elif c == chars_col:
            cols.append(F.when(F.col("cuts").isNotNull(), F.length("changed").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c))
        else:
            cols.append(F.col("row")[c].alias(c))
    return out.select(*cols)
