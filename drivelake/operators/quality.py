"""Data-quality checks as one aggregation.

Every row-level metric the checks need (row count, distinct business keys,
NULL counts, completeness, the Bronze row count of the same scope) comes out
of a single pass: Silver and Bronze are aggregated separately to one row each
and the two rows are folded together (no join).  The 14 (or 6) result rows are
then generated from that one metrics row with ``inline`` - the check logic is
Catalyst expressions, and only schema metadata is evaluated on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.functions.metrics import fixed6, null_rate
from drivelake.schema import BUSINESS_KEY, OPERATIONAL_COLUMNS, Field, normalize_type

# The default rule set, the checked columns, the rule-name
# prefix and the outcome mapping of rule results.
DEFAULT_RULES = (
    'ColumnExists "drive_serial_number"',
    'ColumnExists "drive_model"',
    'ColumnExists "snapshot_date"',
    'Completeness "drive_serial_number" = 1',
    'Completeness "drive_model" = 1',
    'Completeness "snapshot_date" = 1',
    "RowCount > 0",
)
NULL_RATE_COLUMNS = ("drive_serial_number", "drive_model", "snapshot_date")
RULE_PREFIX = "GLUE_DQ::"
SCHEMA_OK_TEXT = ("All canonical columns exist with compatible datatypes. "
                  "Known operational metadata columns are permitted.")
RECONCILIATION_NOTE = "; Silver may be lower because of quarantine and deduplication."
NO_ROWS_TEXT = "No Silver rows found for release_id="
RULE_FAIL_TEXT = " does not meet the constraint requirement!"
SEVERITY = {"PASS": 0, "WARNING": 1, "FAIL": 2}
# Derived partition column of our Silver layout (month of snapshot_date).
DERIVED_COLUMNS = frozenset({"snapshot_month"})

RESULT_COLUMNS = ("check_name", "result", "details", "run_id", "timestamp", "release_id")

_RULE = re.compile(r'^\s*(\w+)\s*(?:"([^"]*)")?\s*(?:(>=|<=|=|>|<)\s*([-+0-9.eE]+))?\s*$')


@dataclass(frozen=True)
class Rule:
    text: str
    kind: str
    column: str | None
    op: str | None
    threshold: float | None


def parse_rule(text: str) -> Rule:
    """Read one rule of the small rule language (ColumnExists, Completeness, RowCount)."""
    m = _RULE.match(text)
    if not m or m.group(1) not in ("ColumnExists", "Completeness", "RowCount"):
        raise ValueError(f"Unsupported rule: {text}")
    thr = float(m.group(4)) if m.group(4) is not None else None
    return Rule(text.strip(), m.group(1), m.group(2), m.group(3), thr)


def _compare(value: Column, op: str, threshold: float) -> Column:
    t = F.lit(threshold)
    return {"=": value == t, ">": value > t, ">=": value >= t, "<": value < t, "<=": value <= t}[op]


def _silver_aggs(silver: DataFrame, keys: Sequence[str], null_columns: Sequence[str]) -> list[Column]:
    present = set(silver.columns)
    aggs = [F.count(F.lit(1)).cast("long").alias("total_rows")]
    if all(k in present for k in keys):
        aggs.append(F.count_distinct(*[F.col(k) for k in keys]).cast("long").alias("distinct_business_keys"))
    else:
        aggs.append(F.lit(None).cast("long").alias("distinct_business_keys"))
    for c in null_columns:
        if c in present:
            aggs.append(F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}"))
        else:
            aggs.append(F.count(F.lit(1)).cast("long").alias(f"null_{c}"))
    return aggs


def dq_metrics(silver: DataFrame, keys: Sequence[str] = BUSINESS_KEY,
               null_columns: Sequence[str] = NULL_RATE_COLUMNS) -> DataFrame:
    """A1: one row - total rows, distinct keys (tuples holding a NULL are not
    counted, Q7), NULL count per checked column."""
    return silver.agg(*_silver_aggs(silver, keys, null_columns))


def schema_check(columns: Sequence[tuple[str, str]], fields: Sequence[Field]) -> tuple[list, list, list]:
    """(missing canonical, unexpected, type mismatch texts) from metadata."""
    expected = {f.name: f.type_name for f in fields}
    actual = {n: normalize_type(t) for n, t in columns}
    missing = [n for n in expected if n not in actual]
    allowed = OPERATIONAL_COLUMNS | DERIVED_COLUMNS
    unexpected = [n for n in actual if n not in expected and n not in allowed]
    mismatched = [f"{n}: expected={t}, actual={actual[n]}" for n, t in expected.items()
                  if n in actual and actual[n] != t]
    return missing, unexpected, mismatched


def canonical_relation(spark: SparkSession, fields: Sequence[Field]) -> DataFrame:
    """(ord, column_name, expected): the declared fields as rows."""
    rows = [(i, f.name, f.type_name) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "ord int, column_name string, expected string")


def column_relation(df: DataFrame) -> DataFrame:
    """(place, column_name, actual): the columns of a frame as rows; the frame is planned, not run."""
    rows = [(i, f.name, normalize_type(f.dataType.simpleString())) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "place int, column_name string, actual string")


def schema_findings(canonical: DataFrame, actual: DataFrame) -> DataFrame:
    """A full outer join of both by name, one row per column that differs:
    (finding, at, column_name, expected, actual), where finding is ``missing``,
    ``unexpected`` or ``mismatch`` and at is the order of its text."""
    permitted = sorted(OPERATIONAL_COLUMNS | DERIVED_COLUMNS)
    finding = (F.when(F.col("place").isNull(), "missing")
               .when(F.col("ord").isNull() & ~F.col("column_name").isin(permitted), "unexpected")
               .when(F.col("expected") != F.col("actual"), "mismatch"))
    both = canonical.join(actual, "column_name", "full_outer").withColumn("finding", finding).where("finding is not null")
    return both.select("finding", F.coalesce("ord", "place").alias("at"), "column_name", "expected", "actual")


def schema_compatibility(canonical: DataFrame, actual: DataFrame) -> DataFrame:
    """The ``schema_compatibility`` row (check_name, result, details) of two relations of columns."""
    text = F.when(F.col("finding") == "mismatch", F.concat("column_name", F.lit(": expected="), "expected", F.lit(", actual="), "actual")).otherwise(F.col("column_name"))
    found = schema_findings(canonical, actual).select("finding", F.struct("at", F.concat(F.lit("'"), text, F.lit("'")).alias("text")).alias("x"))

    def listed(kind: str) -> Column:
        texts = F.transform(F.array_sort(F.collect_list(F.when(F.col("finding") == kind, F.col("x")))), lambda x: x["text"])
        return F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]"))

    d = found.agg(F.count("*").alias("n"), listed("missing").alias("missing"), listed("unexpected").alias("unexpected"), listed("mismatch").alias("mismatch"))
    details = F.concat(F.lit("missing_canonical="), "missing", F.lit("; unexpected_columns="), "unexpected", F.lit("; type_mismatches="), "mismatch")
    return d.select(F.lit("schema_compatibility").alias("check_name"), F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("result"),
                    F.when(F.col("n") == 0, SCHEMA_OK_TEXT).otherwise(details).alias("details"))


def _metrics_row(silver: DataFrame, bronze: DataFrame | None, rules: Sequence[Rule],
                 by: Sequence[str] = ()) -> DataFrame:
    """Silver metrics + rule metrics + the Bronze count: one row per ``by``
    group (one row in total without grouping).  The Silver and Bronze
    aggregates are unioned and folded by group - no join."""
    present = set(silver.columns)
    aggs = _silver_aggs(silver, BUSINESS_KEY, NULL_RATE_COLUMNS)
    for i, r in enumerate(rules):
        if r.kind == "Completeness" and r.column in present:
            aggs.append(F.count(F.col(r.column)).cast("long").alias(f"_nonnull_{i}"))
    s = silver.groupBy(*by).agg(*aggs)
    if bronze is None:
        return s.withColumn("bronze_rows", F.lit(None).cast("long"))
    b = bronze.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("bronze_rows"))
    u = s.unionByName(b, allowMissingColumns=True)
    counts = [c for c in u.columns if c not in by and c not in ("distinct_business_keys", "bronze_rows")]
    folded = u.groupBy(*by).agg(*[F.max(c).alias(c) for c in u.columns if c not in by])
    # a group with Bronze rows but no Silver row has zero Silver counts
    return folded.fillna(0, subset=counts + ["distinct_business_keys", "bronze_rows"])


def scope_measures(in_scope: Column, rules: Sequence[str] = DEFAULT_RULES) -> dict[str, Column]:
    """The metrics of ``evaluate`` as aggregates without a distinct count, for a frame that holds every business
    key once, such as the rows of an upsert: there the distinct keys are the rows without a NULL in the key."""
    whole_key = in_scope
    for k in BUSINESS_KEY:
        whole_key = whole_key & F.col(k).isNotNull()
    out = {"total_rows": F.count_if(in_scope), "distinct_business_keys": F.count_if(whole_key)}
    out.update({f"null_{c}": F.count_if(in_scope & F.col(c).isNull()) for c in NULL_RATE_COLUMNS})
    for i, r in enumerate(map(parse_rule, rules)):
        if r.kind == "Completeness":
            out[f"_nonnull_{i}"] = F.count_if(in_scope & F.col(r.column).isNotNull())
    return {n: F.coalesce(c, F.lit(0)).cast("long") for n, c in out.items()}


def _struct(order: int, name: str, result: Column, details: Column, gate: Column) -> Column:
    return F.struct(F.lit(order).alias("check_order"), F.lit(name).alias("check_name"),
                    result.alias("result"), details.alias("details"), gate.alias("_gate"))


def evaluate(silver: DataFrame, bronze: DataFrame | None, fields: Sequence[Field],
             run_id: str, release_id: str | None, rules: Sequence[str] = DEFAULT_RULES,
             by_release: bool = False, measured: dict | None = None) -> DataFrame:
    """The check rows of one scope (Silver and Bronze scoped alike).

    With ``measured`` (``scope_measures`` taken while Silver was written, and
    ``bronze_rows``) neither is scanned: of Silver only the columns are looked at.

    Columns: ``check_order`` plus the six result columns.  D2-D6 only appear
    when the scope has rows.  With ``by_release`` the scope is a set of
    releases and every release gets its own check rows from the same single
    grouped aggregation (a multi-release backfill checks all releases in one
    pass).
    """
    parsed = [parse_rule(r) for r in rules]
    present = set(silver.columns)
    by = ("release_id",) if by_release else ()
    if measured is None:
        m = _metrics_row(silver, bronze, parsed, by)
    else:
        m = silver.sparkSession.createDataFrame([tuple(measured.values())], ", ".join(f"{n} long" for n in measured))
    release_text = (F.coalesce(F.col("release_id"), F.lit("None")) if by_release
                    else F.lit(str(release_id)))
    total = F.col("total_rows")
    nonempty = total > 0
    checks = []
    checks.append(_struct(
        0, "row_count", F.when(nonempty, "PASS").otherwise("FAIL"),
        F.when(nonempty, F.concat(F.lit("silver_rows="), total.cast("string")))
        .otherwise(F.concat(F.lit(NO_ROWS_TEXT), release_text, F.lit("."))),
        F.lit(True)))
    for i, r in enumerate(parsed):
        fail_reason = F.lit(None).cast("string")
        if r.kind == "ColumnExists":
            ok = F.lit(r.column in present)
            fail_reason = F.lit(None if r.column in present else f"Column {r.column} does not exist.")
            metrics = F.lit("{}")
        elif r.kind == "Completeness":
            if r.column in present:
                value = F.try_divide(F.col(f"_nonnull_{i}").cast("double"), total.cast("double"))
                ok = _compare(value, r.op or "=", r.threshold if r.threshold is not None else 1.0)
                fail_reason = F.when(~ok, F.concat(F.lit("Value: "), value.cast("string"),
                                                   F.lit(RULE_FAIL_TEXT)))
                metrics = F.concat(F.lit(f"{{Column.{r.column}.Completeness: "), value.cast("string"), F.lit("}"))
            else:
                ok = F.lit(False)
                fail_reason = F.lit(f"Column {r.column} does not exist.")
                metrics = F.lit("{}")
        else:  # RowCount
            value = total.cast("double")
            ok = _compare(value, r.op or ">", r.threshold if r.threshold is not None else 0.0)
            fail_reason = F.when(~ok, F.concat(F.lit("Value: "), value.cast("string"),
                                               F.lit(RULE_FAIL_TEXT)))
            metrics = F.concat(F.lit("{Dataset.*.RowCount: "), value.cast("string"), F.lit("}"))
        outcome = F.when(ok, "PASSED").otherwise("FAILED")
        result = F.when(outcome == "PASSED", "PASS").when(outcome.isin("FAILED", "ERROR"), "FAIL").otherwise("WARNING")
        details = F.concat(F.lit(f"rule={r.text}; failure_reason="), F.coalesce(fail_reason, F.lit("None")),
                           F.lit("; metrics="), metrics)
        checks.append(_struct(1 + i, RULE_PREFIX + r.text, result, details, nonempty))
    n = 1 + len(parsed)
    distinct = F.col("distinct_business_keys")
    unique = total == distinct
    checks.append(_struct(
        n, "business_key_uniqueness", F.when(unique, "PASS").otherwise("FAIL"),
        F.concat(F.lit("rows="), total.cast("string"), F.lit("; distinct_keys="), F.coalesce(distinct.cast("string"), F.lit("None")),
                 F.when(~unique | distinct.isNull(),
                        F.concat(F.lit("; duplicate_rows="), F.coalesce((total - distinct).cast("string"), F.lit("None"))))
                 .otherwise(F.lit(""))),
        nonempty))
    for j, c in enumerate(NULL_RATE_COLUMNS):
        nulls = F.col(f"null_{c}")
        rate = null_rate(nulls, total)
        checks.append(_struct(
            n + 1 + j, f"null_rate::{c}", F.when(rate == 0.0, "PASS").otherwise("FAIL"),
            F.concat(F.lit("null_count="), nulls.cast("string"), F.lit("; total_rows="), total.cast("string"),
                     F.lit("; null_rate="), fixed6(rate)),
            F.lit(True)))
    missing, unexpected, mismatched = schema_check(
        [(f.name, f.dataType.simpleString()) for f in silver.schema.fields], fields)
    if not (missing or unexpected or mismatched):
        schema_result, schema_details = "PASS", SCHEMA_OK_TEXT
    else:
        schema_result = "FAIL"
        schema_details = (f"missing_canonical={missing}; unexpected_columns={unexpected}; "
                          f"type_mismatches={mismatched}")
    checks.append(_struct(n + 4, "schema_compatibility", F.lit(schema_result), F.lit(schema_details), F.lit(True)))
    bronze_rows = F.col("bronze_rows")
    diff = bronze_rows - total
    checks.append(_struct(
        n + 5, "bronze_silver_row_reconciliation", F.when(diff >= 0, "PASS").otherwise("FAIL"),
        F.concat(F.lit("bronze_rows="), bronze_rows.cast("string"), F.lit("; silver_rows="), total.cast("string"),
                 F.lit("; difference="), diff.cast("string"),
                 F.lit(RECONCILIATION_NOTE)),
        F.lit(bronze is not None)))
    rows = m.select(*by, F.inline(F.array(*checks))).filter(F.col("_gate")).drop("_gate")
    rows = rows.withColumns({"run_id": F.lit(run_id), "timestamp": F.current_timestamp()})
    if not by_release:
        rows = rows.withColumn("release_id", F.lit(None if release_id is None else str(release_id)).cast("string"))
    return rows.select("check_order", "check_name", "result", "details", "run_id", "timestamp", "release_id")


def verdict(results: DataFrame) -> DataFrame:
    """FAIL if any check failed, else WARNING if any warned, else PASS."""
    rank = (F.when(F.col("result") == "FAIL", 2).when(F.col("result") == "WARNING", 1).otherwise(0))
    worst = F.max(rank)
    return results.agg(F.when(worst == 2, "FAIL").when(worst == 1, "WARNING").otherwise("PASS").alias("overall_status"))


class DataQualityError(RuntimeError):
    pass


def persist_then_fail(spark, results: DataFrame, table) -> str:
    """Write the results first (K7), then stop the run on FAIL.

    The result set is at most 14 rows per release: it is computed once,
    written from the collected rows and the verdicts are folded on the driver.
    Returns the overall verdict; see ``release_verdicts`` for the split.
    """
    return max(persist_results(spark, results, table).values(), key=lambda v: SEVERITY[v])


def persist_results(spark, results: DataFrame, table, raise_on_fail: bool = True) -> dict:
    from drivelake.sinks.tables import create_or_append
    rows = results.drop("check_order").collect()
    create_or_append(spark, spark.createDataFrame(rows, results.drop("check_order").schema), table)
    worst: dict = {}
    for r in rows:
        rel = r["release_id"]
        worst[rel] = max(worst.get(rel, 0), SEVERITY.get(r["result"], 1))
    verdicts = {rel: {0: "PASS", 1: "WARNING", 2: "FAIL"}[w] for rel, w in worst.items()} or {None: "FAIL"}
    failed = sorted(str(k) for k, v in verdicts.items() if v == "FAIL")
    if failed and raise_on_fail:
        raise DataQualityError(f"Data quality verdict is FAIL for release(s) {', '.join(failed)}; "
                               "see the DQ results table.")
    return verdicts
