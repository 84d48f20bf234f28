"""The registered queries: one per operator group of SURVEY section 2.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on full
driver tables; ``ORACLE[name]`` is the DuckDB SQL that recomputes the same
result.  Columns that cannot be compared across engines (run-time
timestamps, random run ids) are left out of query outputs.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.functions.casts import blank_to_null, lenient_cast, strict_date
from drivelake.operators import bronze as B
from drivelake.operators import gold as G
from drivelake.operators import quality as Q
from drivelake.operators import registry as R
from drivelake.operators import silver as S
from drivelake.plans import observations as O
from drivelake.plans import oracle as X
from drivelake.plans.backfill import silver_frames
from drivelake.schema import drivestats_fields, fields_from_mapping
from drivelake.sinks.tables import align, evolve, newest_generation, replace_partitions
from drivelake.sources.tables import scope

RUN_ID = "catalogue-run"
FIELDS = drivestats_fields()
SILVER_OUT = ["release_id", "snapshot_date", "drive_serial_number", "drive_model", "capacity_bytes",
              "failure_flag", "smart_9_raw", "source_file"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _li_silver(spark, sf_dir):
    return silver_frames(O.lineitem_bronze(spark, sf_dir), FIELDS, RUN_ID)[0]


def _ev_silver(spark, sf_dir):
    return silver_frames(O.events_bronze(spark, sf_dir), FIELDS, RUN_ID)[0]


# ------------------------------------------------------------------ bronze

@query("bronze_stringify_stamp", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, props,
  'raw/drivestats/events/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '.csv' AS source_file,
  '2024_Q1' AS release_id, 'catalogue-run' AS processing_run_id
FROM events""")
def bronze_stringify_stamp(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    raw = e.select("event_id", "user_id", "event_type", "props",
                   F.concat(F.lit("raw/drivestats/events/"), F.date_format(F.to_date("ts"), "yyyy-MM-dd"),
                            F.lit(".csv")).alias("source_file"))
    return B.bronze_frame(raw, "2024_Q1", RUN_ID).drop("ingested_at")


@query("scope_release", "WITH b AS (" + X.lineitem_bronze() + """)
SELECT date, serial_number, model, failure, source_file, release_id FROM b WHERE release_id = '1996'""")
def scope_release(spark, sf_dir):
    b = scope(O.lineitem_bronze(spark, sf_dir), release_id="1996")
    return b.select("date", "serial_number", "model", "failure", "source_file", "release_id")


@query("scope_source_file", "WITH b AS (" + X.events_bronze() + """)
SELECT date, serial_number, model, failure, source_file, release_id FROM b
WHERE release_id = '2024_Q1' AND source_file = 'raw/drivestats/2024_Q1/2024-01-15.csv'""")
def scope_source_file(spark, sf_dir):
    b = scope(O.events_bronze(spark, sf_dir), release_id="2024_Q1",
              source_file="raw/drivestats/2024_Q1/2024-01-15.csv")
    return b.select("date", "serial_number", "model", "failure", "source_file", "release_id")


@query("align_to_schema", """
SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
  CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier""")
def align_to_schema(spark, sf_dir):
    target = _t(spark, sf_dir, "customer").schema
    sup = _t(spark, sf_dir, "supplier")
    renamed = sup.select(*[F.col(c).alias("c_custkey" if c == "s_suppkey" else "c_" + c[2:]) for c in sup.columns])
    return align(renamed, target)


@query("evolve_union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
  c_mktsegment AS mktsegment, 'customer' AS origin FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def evolve_union_by_name(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    sup = _t(spark, sf_dir, "supplier")
    c = cust.select(*[F.col(x).alias(x.split("_", 1)[1].replace("custkey", "key")) for x in cust.columns])
    s = sup.select(*[F.col(x).alias(x.split("_", 1)[1].replace("suppkey", "key")) for x in sup.columns])
    c = c.withColumn("origin", F.lit("customer"))
    s = s.withColumn("origin", F.lit("supplier"))
    added = evolve(s.schema, c.columns)  # E1: columns the first drop adds (mktsegment)
    assert added == ["mktsegment"], added
    return s.unionByName(c, allowMissingColumns=True).select("key", "name", "nationkey", "acctbal", *added, "origin")


# ------------------------------------------------------------------ silver

def _canonical(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    return b.select(*S.canonicalize(b, FIELDS), "release_id", "source_file")


@query("canonical_projection", "WITH b AS (" + X.events_bronze() + ")\nSELECT "
       + ",\n  ".join(X.field_sql(f, X.EVENTS_COLUMNS) for f in FIELDS) + ", release_id, source_file FROM b")
def canonical_projection(spark, sf_dir):
    return _canonical(spark, sf_dir)


#: A schema with declared transformations, as a document would hold it.
SIGHTINGS = fields_from_mapping([
    {"name": "seen_at", "source_column": "date", "datatype": "timestamp", "nullable": False, "transformation": "to_timestamp"},
    {"name": "seen_on", "source_column": "date", "datatype": "date"},
    {"name": "drive_serial_number", "source_column": "serial_number", "datatype": "string", "nullable": False},
    {"name": "hours", "source_column": "smart_9_raw", "datatype": "Long"},
    {"name": "level", "source_column": "smart_1_normalized", "datatype": "Integer", "nullable": False}])


@query("parse_rules", "WITH b AS (" + X.events_bronze() + ")\nSELECT * EXCLUDE (ingested_at) FROM ("
       + X.candidate_sql("b", X.EVENTS_COLUMNS, SIGHTINGS) + ") c")
def parse_rules(spark, sf_dir):
    """A required timestamp field; value, validity and SQL follow the schema's parse rules."""
    return S.candidate(O.events_bronze(spark, sf_dir), SIGHTINGS).drop("ingested_at")


@query("lenient_int_cast", "WITH b AS (" + X.events_bronze() + f""")
SELECT failure, {X.lenient('failure', 'INTEGER')} AS failure_int,
  smart_1_normalized, {X.lenient('smart_1_normalized', 'INTEGER')} AS smart_1_int,
  capacity_bytes, {X.lenient('capacity_bytes', 'BIGINT')} AS capacity_bigint,
  smart_194_raw, {X.lenient('smart_194_raw', 'BIGINT')} AS smart_194_bigint
FROM b""")
def lenient_int_cast(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    return b.select("failure", lenient_cast("failure", "int").alias("failure_int"),
                    "smart_1_normalized", lenient_cast("smart_1_normalized", "int").alias("smart_1_int"),
                    "capacity_bytes", lenient_cast("capacity_bytes", "bigint").alias("capacity_bigint"),
                    "smart_194_raw", lenient_cast("smart_194_raw", "bigint").alias("smart_194_bigint"))


@query("strict_date_parse", "WITH b AS (" + X.events_bronze() + f""")
SELECT date, {X.strict_date('date')} AS snapshot_date FROM b""")
def strict_date_parse(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    return b.select("date", strict_date("date").alias("snapshot_date"))


@query("blank_to_null", f"""
SELECT doc_id, {X.blank_null('lang')} AS lang, {X.blank_null('source')} AS source,
  CAST(length({X.blank_null('text')}) AS BIGINT) AS text_chars
FROM documents""")
def blank_to_null_q(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", blank_to_null("lang").alias("lang"), blank_to_null("source").alias("source"),
                    F.length(blank_to_null("text")).cast("long").alias("text_chars"))


@query("quarantine_rows", "WITH b AS (" + X.events_bronze() + "), c AS (" + X.candidate_sql("b", X.EVENTS_COLUMNS) + """)
SELECT snapshot_date, drive_serial_number, drive_model, failure_flag, release_id, source_file,
  _rejection_reason AS rejection_reason, 'catalogue-run' AS quarantine_processing_run_id
FROM c WHERE _rejection_reason IS NOT NULL""")
def quarantine_rows(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    _, rejected = S.split_valid(S.candidate(b, FIELDS))
    q = S.stamp_quarantine(rejected, RUN_ID)
    return q.select("snapshot_date", "drive_serial_number", "drive_model", "failure_flag", "release_id",
                    "source_file", "rejection_reason", "quarantine_processing_run_id")


@query("quarantine_schema", "WITH b AS (" + X.events_bronze() + """)
SELECT date, serial_number, failure, release_id, source_file,
  'missing_required_source_column:drive_model' AS rejection_reason FROM b""")
def quarantine_schema(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir).drop("model")
    missing = S.missing_required(FIELDS, b.columns)
    q = S.quarantine_schema(b, missing, RUN_ID)
    return q.select("date", "serial_number", "failure", "release_id", "source_file", "rejection_reason")


@query("accepted_rows", "WITH b AS (" + X.events_bronze() + "), c AS (" + X.candidate_sql("b", X.EVENTS_COLUMNS) + """)
SELECT * EXCLUDE (_rejection_reason, ingested_at) FROM c WHERE _rejection_reason IS NULL""")
def accepted_rows(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    accepted, _ = S.split_valid(S.candidate(b, FIELDS))
    return accepted.drop("ingested_at")


@query("dedup_latest", X.events_silver_with() + "SELECT " + ", ".join(SILVER_OUT) + " FROM ev_silver")
def dedup_latest_events(spark, sf_dir):
    return _ev_silver(spark, sf_dir).select(*SILVER_OUT)


@query("dedup_latest_lineitem", X.lineitem_silver_with() + "SELECT " + ", ".join(SILVER_OUT) + " FROM li_silver")
def dedup_latest_lineitem(spark, sf_dir):
    return _li_silver(spark, sf_dir).select(*SILVER_OUT)


# ------------------------------------------------------------------ tables

_ORDERS_GEN = """
WITH gen1 AS (
  SELECT o_orderkey AS order_key, CAST(year(o_orderdate) AS VARCHAR) AS release_id,
         o_orderstatus AS status, o_totalprice AS amount, 1 AS generation FROM orders),
gen2 AS (
  SELECT o_orderkey AS order_key, CAST(year(o_orderdate) AS VARCHAR) AS release_id,
         'F' AS status, o_totalprice * 2 AS amount, 2 AS generation FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey + 100000000 AS order_key, CAST(year(o_orderdate) AS VARCHAR) AS release_id,
         o_orderstatus AS status, o_totalprice AS amount, 2 AS generation FROM orders
  WHERE o_orderpriority = '1-URGENT')
"""


def _orders_generations(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    rel = F.year("o_orderdate").cast("string").alias("release_id")
    gen1 = o.select(F.col("o_orderkey").alias("order_key"), rel, F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("amount"), F.lit(1).alias("generation"))
    upd = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("order_key"), rel, F.lit("F").alias("status"),
        (F.col("o_totalprice") * 2).alias("amount"), F.lit(2).alias("generation"))
    ins = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        (F.col("o_orderkey") + 100000000).alias("order_key"), rel, F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"), F.lit(2).alias("generation"))
    return gen1, upd.unionByName(ins)


@query("merge_upsert", _ORDERS_GEN + """
SELECT * FROM gen1 WHERE NOT EXISTS (
  SELECT 1 FROM gen2 WHERE gen2.order_key = gen1.order_key AND gen2.release_id = gen1.release_id)
UNION ALL SELECT * FROM gen2""")
def merge_upsert(spark, sf_dir):
    gen1, gen2 = _orders_generations(spark, sf_dir)
    return newest_generation(gen1, gen2, ["release_id", "order_key"])


@query("overwrite_partitions", X.with_views(
    li_bronze=X.lineitem_bronze(),
    li_silver=X.silver_sql("li_bronze", X.LINEITEM_COLUMNS, "", X.LINEITEM_REST),
    g=X.model_metrics_sql("li_silver")) + """
SELECT * FROM g WHERE release_id NOT IN ('1996', '2000')
UNION ALL
SELECT release_id, drive_model, distinct_drives, total_drive_days, 0 AS drive_failures,
  CAST(0.0 AS DOUBLE) AS annualized_failure_rate_pct, first_snapshot_date, last_snapshot_date
FROM g WHERE release_id IN ('1996', '2000')""")
def overwrite_partitions_q(spark, sf_dir):
    model = G.model_metrics(_li_silver(spark, sf_dir))
    restated = (model.filter(F.col("release_id").isin("1996", "2000"))
                .withColumns({"drive_failures": F.lit(0).cast("long"),
                              "annualized_failure_rate_pct": F.lit(0.0)}))
    return replace_partitions(model, restated, ["release_id"])


# ------------------------------------------------------------------ gold

@query("gold_release_metrics", X.lineitem_silver_with() + X.release_metrics_sql("li_silver"))
def gold_release_metrics(spark, sf_dir):
    return G.release_metrics(_li_silver(spark, sf_dir))


@query("gold_model_metrics", X.lineitem_silver_with() + X.model_metrics_sql("li_silver"))
def gold_model_metrics(spark, sf_dir):
    return G.model_metrics(_li_silver(spark, sf_dir))


@query("gold_model_metrics_events", X.events_silver_with() + X.model_metrics_sql("ev_silver"))
def gold_model_metrics_events(spark, sf_dir):
    return G.model_metrics(_ev_silver(spark, sf_dir))


@query("gold_input_violations", X.events_silver_with() + """
SELECT release_id, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(sum(failure_flag) AS BIGINT) AS silver_failures,
  CAST(count(*) FILTER (WHERE drive_serial_number IS NULL) AS BIGINT) AS null_serial_rows,
  CAST(count(*) FILTER (WHERE drive_model IS NULL OR trim(drive_model, ' ') = '') AS BIGINT) AS null_model_rows,
  CAST(count(*) FILTER (WHERE snapshot_date IS NULL) AS BIGINT) AS null_date_rows,
  CAST(count(*) FILTER (WHERE failure_flag IS NULL OR failure_flag NOT IN (0, 1)) AS BIGINT) AS invalid_failure_rows,
  min(snapshot_date) AS start_date, max(snapshot_date) AS end_date,
  CAST(year(min(snapshot_date)) AS INTEGER) AS start_year, CAST(year(max(snapshot_date)) AS INTEGER) AS end_year,
  year(min(snapshot_date)) = year(max(snapshot_date)) AS single_year
FROM ev_silver GROUP BY release_id""")
def gold_input_violations(spark, sf_dir):
    return G.gold_input_report(_ev_silver(spark, sf_dir))


@query("gold_year_guard", X.lineitem_silver_with() + """
SELECT CAST(year(snapshot_date + INTERVAL 3 MONTH) AS VARCHAR) AS release_id,
  min(snapshot_date) AS start_date, max(snapshot_date) AS end_date,
  CAST(year(min(snapshot_date)) AS INTEGER) AS start_year, CAST(year(max(snapshot_date)) AS INTEGER) AS end_year,
  year(min(snapshot_date)) = year(max(snapshot_date)) AS single_year
FROM li_silver GROUP BY 1""")
def gold_year_guard(spark, sf_dir):
    s = _li_silver(spark, sf_dir).withColumn(
        "release_id", F.year(F.add_months("snapshot_date", 3)).cast("string"))
    return G.gold_input_report(s).select("release_id", "start_date", "end_date", "start_year", "end_year",
                                         "single_year")


@query("gold_reconciliation", X.with_views(
    li_bronze=X.lineitem_bronze(),
    li_silver=X.silver_sql("li_bronze", X.LINEITEM_COLUMNS, "", X.LINEITEM_REST),
    rel=X.release_metrics_sql("li_silver"),
    mdl=X.model_metrics_sql("li_silver")) + """,
s AS (SELECT release_id, CAST(count(*) AS BIGINT) AS silver_drive_days,
             CAST(sum(failure_flag) AS BIGINT) AS silver_failures FROM li_silver GROUP BY 1),
m AS (SELECT release_id, CAST(count(*) AS BIGINT) AS model_rows, CAST(sum(total_drive_days) AS BIGINT) AS model_drive_days,
             CAST(sum(drive_failures) AS BIGINT) AS model_failures FROM mdl GROUP BY 1),
r AS (SELECT release_id, CAST(count(*) AS BIGINT) AS release_rows, CAST(sum(total_drive_days) AS BIGINT) AS release_drive_days,
             CAST(sum(drive_failures) AS BIGINT) AS release_failures FROM rel GROUP BY 1)
SELECT s.release_id, silver_drive_days, silver_failures, model_rows, model_drive_days, model_failures,
  release_rows, release_drive_days, release_failures,
  model_rows > 0 AS model_rows_ok, release_rows = 1 AS release_rows_ok,
  silver_drive_days = model_drive_days AND silver_drive_days = release_drive_days AS drive_days_ok,
  silver_failures = model_failures AND silver_failures = release_failures AS failures_ok
FROM s JOIN m USING (release_id) JOIN r USING (release_id)""")
def gold_reconciliation(spark, sf_dir):
    s = _li_silver(spark, sf_dir).select(*G.GOLD_INPUT_COLUMNS)
    return G.conservation(s, G.release_metrics(s), G.model_metrics(s))


# ------------------------------------------------------------------ data quality

def _dq_sql_metrics(src: str, grouped: bool = False) -> str:
    return f"""SELECT {"release_id, " if grouped else ""}CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(DISTINCT (release_id, snapshot_date, drive_serial_number)) FILTER (
    WHERE release_id IS NOT NULL AND snapshot_date IS NOT NULL AND drive_serial_number IS NOT NULL) AS BIGINT)
    AS distinct_business_keys,
  CAST(count(*) FILTER (WHERE drive_serial_number IS NULL) AS BIGINT) AS null_drive_serial_number,
  CAST(count(*) FILTER (WHERE drive_model IS NULL) AS BIGINT) AS null_drive_model,
  CAST(count(*) FILTER (WHERE snapshot_date IS NULL) AS BIGINT) AS null_snapshot_date,
  CAST(count(drive_serial_number) AS BIGINT) AS nonnull_drive_serial_number,
  CAST(count(drive_model) AS BIGINT) AS nonnull_drive_model,
  CAST(count(snapshot_date) AS BIGINT) AS nonnull_snapshot_date
FROM {src}{" GROUP BY release_id" if grouped else ""}"""


@query("dq_metrics", "WITH b AS (" + X.events_bronze() + "), c AS (" + X.candidate_sql("b", X.EVENTS_COLUMNS)
       + ")\nSELECT * EXCLUDE (nonnull_drive_serial_number, nonnull_drive_model, nonnull_snapshot_date) FROM ("
       + _dq_sql_metrics("c") + ")")
def dq_metrics(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    return Q.dq_metrics(S.candidate(b, FIELDS))


def _null_rate_rows_sql(m: str, rel: str = "") -> str:
    parts = []
    for i, c in enumerate(Q.NULL_RATE_COLUMNS):
        rate = f"(CASE WHEN total_rows > 0 THEN CAST(null_{c} AS DOUBLE) / CAST(total_rows AS DOUBLE) ELSE 1.0 END)"
        parts.append(f"""SELECT {rel}{9 + i} AS check_order, 'null_rate::{c}' AS check_name,
  CASE WHEN {rate} = 0.0 THEN 'PASS' ELSE 'FAIL' END AS result,
  'null_count=' || null_{c} || '; total_rows=' || total_rows || '; null_rate=' || printf('%.6f', {rate}) AS details
FROM {m}""")
    return "\nUNION ALL\n".join(parts)


def _dq_results_sql(silver_cte: str, bronze_cte: str, grouped: bool = False) -> str:
    """The D1-D9 rows in SQL; ``grouped`` gives one set per release."""
    rel = "release_id, " if grouped else ""
    rule_rows = []
    for i, r in enumerate(Q.DEFAULT_RULES, start=1):
        rule = Q.parse_rule(r)
        if rule.kind == "ColumnExists":
            details = f"'rule={r}; failure_reason=None; metrics={{}}'"
            result = "'PASS'"
        elif rule.kind == "Completeness":
            v = f"CAST(nonnull_{rule.column} AS DOUBLE) / CAST(total_rows AS DOUBLE)"
            result = f"CASE WHEN {v} = 1.0 THEN 'PASS' ELSE 'FAIL' END"
            details = (f"'rule={r}; failure_reason=' || CASE WHEN {v} = 1.0 THEN 'None' ELSE 'Value: ' || CAST({v} AS VARCHAR)"
                       f" || ' does not meet the constraint requirement!' END || '; metrics={{Column.{rule.column}.Completeness: '"
                       f" || CAST({v} AS VARCHAR) || '}}'")
        else:
            v = "CAST(total_rows AS DOUBLE)"
            result = f"CASE WHEN {v} > 0 THEN 'PASS' ELSE 'FAIL' END"
            details = (f"'rule={r}; failure_reason=' || CASE WHEN {v} > 0 THEN 'None' ELSE 'Value: ' || CAST({v} AS VARCHAR)"
                       f" || ' does not meet the constraint requirement!' END || '; metrics={{Dataset.*.RowCount: '"
                       f" || CAST({v} AS VARCHAR) || '}}'")
        rule_rows.append(f"SELECT {rel}{i} AS check_order, '{Q.RULE_PREFIX}{r}' AS check_name, {result} AS result, "
                         f"{details} AS details FROM m WHERE total_rows > 0")
    schema_ok = ("All canonical columns exist with compatible datatypes. "
                 "Known operational metadata columns are permitted.")
    if grouped:
        counts = ["total_rows", "distinct_business_keys", "null_drive_serial_number", "null_drive_model",
                  "null_snapshot_date", "nonnull_drive_serial_number", "nonnull_drive_model", "nonnull_snapshot_date"]
        m = (f"SELECT coalesce(x.release_id, b.release_id) AS release_id, "
             + ", ".join(f"coalesce(x.{c}, 0) AS {c}" for c in counts)
             + f", coalesce(b.bronze_rows, 0) AS bronze_rows FROM ({_dq_sql_metrics(silver_cte, True)}) x "
             f"FULL OUTER JOIN (SELECT release_id, CAST(count(*) AS BIGINT) AS bronze_rows FROM {bronze_cte} "
             f"GROUP BY release_id) b ON x.release_id = b.release_id")
        no_rows = "'No Silver rows found for release_id=' || release_id || '.'"
    else:
        m = (f"SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM {bronze_cte}) AS bronze_rows "
             f"FROM ({_dq_sql_metrics(silver_cte)}) x")
        no_rows = "'No Silver rows found for release_id=2024_Q1.'"
    return f"""WITH m AS ({m})
SELECT {rel}0 AS check_order, 'row_count' AS check_name, CASE WHEN total_rows > 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  CASE WHEN total_rows > 0 THEN 'silver_rows=' || total_rows ELSE {no_rows} END AS details
FROM m
UNION ALL
{chr(10).join('UNION ALL ' + x if k else x for k, x in enumerate(rule_rows))}
UNION ALL
SELECT {rel}8, 'business_key_uniqueness', CASE WHEN total_rows = distinct_business_keys THEN 'PASS' ELSE 'FAIL' END,
  'rows=' || total_rows || '; distinct_keys=' || distinct_business_keys ||
  CASE WHEN total_rows = distinct_business_keys THEN '' ELSE '; duplicate_rows=' || (total_rows - distinct_business_keys) END
FROM m WHERE total_rows > 0
UNION ALL
{_null_rate_rows_sql('m', rel)}
UNION ALL
SELECT {rel}12, 'schema_compatibility', 'PASS', '{schema_ok}' FROM m
UNION ALL
SELECT {rel}13, 'bronze_silver_row_reconciliation', CASE WHEN bronze_rows - total_rows >= 0 THEN 'PASS' ELSE 'FAIL' END,
  'bronze_rows=' || bronze_rows || '; silver_rows=' || total_rows || '; difference=' || (bronze_rows - total_rows)
  || '; Silver may be lower because of quarantine and deduplication.'
FROM m"""


def _ev_dq_results(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    silver = silver_frames(b, FIELDS, RUN_ID)[0]
    res = Q.evaluate(silver, b, FIELDS, RUN_ID, "2024_Q1")
    return res.select("check_order", "check_name", "result", "details", "release_id")


_DQ_EVENTS_SQL = (X.with_views(ev_bronze=X.events_bronze(),
                               ev_silver=X.silver_sql("ev_bronze", X.EVENTS_COLUMNS, "", X.EVENTS_REST))
                  + "SELECT *, '2024_Q1' AS release_id FROM (" + _dq_results_sql("ev_silver", "ev_bronze") + ") r")


@query("dq_results", _DQ_EVENTS_SQL)
def dq_results(spark, sf_dir):
    return _ev_dq_results(spark, sf_dir)


@query("dq_results_by_release", X.with_views(
    li_bronze=X.lineitem_bronze(),
    li_silver=X.silver_sql("li_bronze", X.LINEITEM_COLUMNS, "", X.LINEITEM_REST))
    + "SELECT * FROM (" + _dq_results_sql("li_silver", "li_bronze", grouped=True) + ") r")
def dq_results_by_release(spark, sf_dir):
    """D1-D9 for every release of a multi-release scope from one grouped
    aggregation (the backfill path)."""
    b = O.lineitem_bronze(spark, sf_dir)
    silver = silver_frames(b, FIELDS, RUN_ID)[0]
    res = Q.evaluate(silver, b, FIELDS, RUN_ID, None, by_release=True)
    return res.select("check_order", "check_name", "result", "details", "release_id")


@query("dq_overall", "SELECT CASE WHEN max(CASE result WHEN 'FAIL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) = 2 "
       "THEN 'FAIL' WHEN max(CASE result WHEN 'FAIL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) = 1 THEN 'WARNING' "
       "ELSE 'PASS' END AS overall_status FROM (" + _DQ_EVENTS_SQL + ") q")
def dq_overall(spark, sf_dir):
    return Q.verdict(_ev_dq_results(spark, sf_dir))


@query("dq_null_rates", "WITH b AS (" + X.events_bronze() + "), c AS (" + X.candidate_sql("b", X.EVENTS_COLUMNS)
       + "), m AS (" + _dq_sql_metrics("c") + ")\n" + _null_rate_rows_sql("m"))
def dq_null_rates(spark, sf_dir):
    b = O.events_bronze(spark, sf_dir)
    cand = S.candidate(b, FIELDS)
    res = Q.evaluate(cand, None, FIELDS, RUN_ID, "2024_Q1")
    return res.filter(F.col("check_name").startswith("null_rate::")).select(
        "check_order", "check_name", "result", "details")


@query("dq_uniqueness", "WITH b AS (" + X.lineitem_bronze() + "), c AS (" + X.candidate_sql("b", X.LINEITEM_COLUMNS)
       + "), m AS (" + _dq_sql_metrics("c WHERE _rejection_reason IS NULL") + """)
SELECT 'business_key_uniqueness' AS check_name, CASE WHEN total_rows = distinct_business_keys THEN 'PASS' ELSE 'FAIL' END AS result,
  'rows=' || total_rows || '; distinct_keys=' || distinct_business_keys ||
  CASE WHEN total_rows = distinct_business_keys THEN '' ELSE '; duplicate_rows=' || (total_rows - distinct_business_keys) END AS details
FROM m""")
def dq_uniqueness(spark, sf_dir):
    b = O.lineitem_bronze(spark, sf_dir)
    accepted, _ = S.split_valid(S.candidate(b, FIELDS))
    res = Q.evaluate(accepted, None, FIELDS, RUN_ID, None)
    return res.filter(F.col("check_name") == "business_key_uniqueness").select("check_name", "result", "details")


def _schema_check_sql() -> str:
    """The declared fields as VALUES against DuckDB's own listing of a drifted Silver."""
    canonical = ", ".join(f"({i}, '{f.name}', '{f.type_name}')" for i, f in enumerate(FIELDS))
    permitted = ", ".join(f"'{c}'" for c in sorted(Q.OPERATIONAL_COLUMNS | Q.DERIVED_COLUMNS))
    listed = lambda kind: f"'[' || coalesce(string_agg(chr(39) || text || chr(39), ', ' ORDER BY at_place) FILTER (WHERE finding = '{kind}'), '') || ']'"
    return f"""WITH canonical(ord, column_name, expected) AS (VALUES {canonical}),
listing AS (SELECT row_number() OVER () - 1 AS place, column_name, column_type FROM (DESCRIBE {X.events_silver_with()}
  SELECT * EXCLUDE (capacity_bytes) REPLACE (CAST(failure_flag AS BIGINT) AS failure_flag), 'x' AS extra_col FROM ev_silver)),
actual AS (SELECT place, column_name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS actual
  FROM listing),
findings AS (SELECT coalesce(ord, place) AS at_place, column_name,
    CASE WHEN place IS NULL THEN 'missing' WHEN ord IS NULL AND column_name NOT IN ({permitted}) THEN 'unexpected'
         WHEN expected <> actual THEN 'mismatch' END AS finding, expected, actual
  FROM canonical FULL OUTER JOIN actual USING (column_name)),
texts AS (SELECT at_place, finding,
    CASE WHEN finding = 'mismatch' THEN column_name || ': expected=' || expected || ', actual=' || actual ELSE column_name END AS text
  FROM findings WHERE finding IS NOT NULL)
SELECT 'schema_compatibility' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  'missing_canonical=' || {listed('missing')} || '; unexpected_columns=' || {listed('unexpected')} || '; type_mismatches=' || {listed('mismatch')} AS details
FROM texts"""


@query("dq_schema_check", _schema_check_sql())
def dq_schema_check(spark, sf_dir):
    """The columns of a drifted Silver against the declared ones, as relations; Silver is planned, not run."""
    s = _ev_silver(spark, sf_dir).drop("capacity_bytes").withColumn("failure_flag", F.col("failure_flag").cast("bigint"))
    return Q.schema_compatibility(Q.canonical_relation(spark, FIELDS), Q.column_relation(s.withColumn("extra_col", F.lit("x"))))


@query("dq_reconciliation", X.events_silver_with() + """
SELECT 'bronze_silver_row_reconciliation' AS check_name,
  CASE WHEN b - s >= 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  'bronze_rows=' || b || '; silver_rows=' || s || '; difference=' || (b - s)
  || '; Silver may be lower because of quarantine and deduplication.' AS details
FROM (SELECT (SELECT count(*) FROM ev_bronze) AS b, (SELECT count(*) FROM ev_silver) AS s) x""")
def dq_reconciliation(spark, sf_dir):
    res = _ev_dq_results(spark, sf_dir)
    return res.filter(F.col("check_name") == "bronze_silver_row_reconciliation").select("check_name", "result", "details")


# ------------------------------------------------------------------ registry

_BUCKET = O.LANDING_BUCKET
_PREFIX = O.RAW_PREFIX


def _events_sql() -> str:
    """Validated object events from pages, recomputed without the JSON round trip."""
    rel = "'R' || CAST(page_id % 3 AS VARCHAR)"
    day = "'2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')"
    raw_key = f"""CASE WHEN page_id % 13 = 0 THEN '{_PREFIX}' || {rel} || '/' || {day} || '.json'
      WHEN page_id % 13 = 1 THEN '{_PREFIX}' || {rel} || '/2024-01.csv'
      WHEN page_id % 13 = 2 THEN '{_PREFIX}' || {day} || '.csv'
      WHEN page_id % 13 = 3 THEN 'tmp/' || {rel} || '/' || {day} || '.csv'
      WHEN page_id % 13 = 4 THEN '{_PREFIX}' || 'Q+' || {rel} || '%20x/' || {day} || '.csv'
      WHEN page_id % 13 = 5 THEN '{_PREFIX}' || '/' || {day} || '.csv'
      ELSE '{_PREFIX}' || {rel} || '/' || {day} || '.csv' END"""
    n = len(_PREFIX)
    return f"""
WITH p AS (
  SELECT page_id AS message_id, to_timestamp(1706745600 + (page_id % 500) * 60)::TIMESTAMP AS received_at,
    CASE WHEN page_id % 11 = 0 THEN 'other-bucket' ELSE '{_BUCKET}' END AS bucket,
    url_decode(replace({raw_key}, '+', ' ')) AS key,
    CAST(length(html) AS BIGINT) AS size_bytes, md5(url) AS etag,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
    CASE WHEN page_id % 17 = 0 THEN 'SQS body is invalid JSON.'
         WHEN page_id % 19 = 0 THEN 'S3 event contains no Records.' END AS message_error
  FROM pages),
k AS (
  SELECT *, substr(key, {n} + 1) AS rel_path, regexp_extract(key, '([^/]*)$', 1) AS name FROM p),
v AS (
  SELECT *,
    CASE WHEN message_error IS NOT NULL THEN message_error
         WHEN bucket <> '{_BUCKET}' THEN 'Unexpected bucket: ' || bucket
         WHEN NOT starts_with(key, '{_PREFIX}') THEN 'Object outside allowed prefix: ' || key
         WHEN strpos(rel_path, '/') = 0 THEN 'Invalid raw object key: ' || key
         WHEN split_part(rel_path, '/', 1) = '' THEN 'Unable to determine release_id: ' || key
         WHEN NOT ends_with(name, '.csv') THEN 'Expected CSV source file: ' || key
         WHEN len(string_split(regexp_extract(name, '^(.*)\\.csv$', 1), '-')) <> 3 THEN 'Invalid date filename: ' || name
    END AS reject_reason,
    CASE WHEN strpos(rel_path, '/') > 0 AND split_part(rel_path, '/', 1) <> '' THEN split_part(rel_path, '/', 1) END AS release_id,
    CASE WHEN ends_with(name, '.csv') AND len(string_split(regexp_extract(name, '^(.*)\\.csv$', 1), '-')) = 3
         THEN regexp_extract(name, '^(.*)\\.csv$', 1) END AS source_date,
    's3://' || bucket || '/' || key AS source_file
  FROM k)
"""


def _validated(spark, sf_dir):
    msgs = O.pages_messages(spark, sf_dir)
    return R.validate(R.read_object_events(msgs), _BUCKET, _PREFIX)


_VALIDATE_COLS = ["message_id", "record_index", "reject_reason", "bucket", "key", "release_id", "source_date",
                  "source_file", "size_bytes", "etag", "event_time"]


@query("events_validate", _events_sql() + """
SELECT message_id, CASE WHEN message_error IS NULL THEN 0 END AS record_index, reject_reason,
  CASE WHEN message_error IS NULL THEN bucket END AS bucket, CASE WHEN message_error IS NULL THEN key END AS key,
  CASE WHEN message_error IS NULL THEN release_id END AS release_id,
  CASE WHEN message_error IS NULL THEN source_date END AS source_date,
  CASE WHEN message_error IS NULL THEN source_file END AS source_file,
  CASE WHEN message_error IS NULL THEN size_bytes END AS size_bytes,
  CASE WHEN message_error IS NULL THEN etag END AS etag,
  CASE WHEN message_error IS NULL THEN event_time END AS event_time
FROM v""")
def events_validate(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.select(*_VALIDATE_COLS)


def _registered(spark, sf_dir):
    msgs = O.pages_messages(spark, sf_dir)
    accepted, _ = R.parse_events(msgs, _BUCKET, _PREFIX)
    return R.register(accepted)


_REGISTER_SQL = _events_sql() + """, a AS (SELECT * FROM v WHERE reject_reason IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY received_at, event_time, message_id) AS rn FROM a)
"""


@query("register_files", _REGISTER_SQL + """
SELECT message_id, source_file, CASE WHEN rn = 1 THEN 'NEW' ELSE 'DUPLICATE' END AS registration,
  'FILE#' || source_file AS control_id, release_id, source_date, etag, 'PENDING' AS status FROM r""")
def register_files(spark, sf_dir):
    return _registered(spark, sf_dir).select("message_id", "source_file", "registration", "control_id",
                                              "release_id", "source_date", "etag", "status")


@query("register_counts", _REGISTER_SQL + """
SELECT CAST(count(*) AS BIGINT) AS processed_count, CAST(count(*) FILTER (WHERE rn = 1) AS BIGINT) AS new_count,
  CAST(count(*) FILTER (WHERE rn > 1) AS BIGINT) AS duplicate_count FROM r""")
def register_counts(spark, sf_dir):
    return R.register_counts(_registered(spark, sf_dir))


@query("pending_worklist", _REGISTER_SQL + """
SELECT source_file, release_id, source_date FROM r WHERE rn = 1
ORDER BY received_at, source_file LIMIT 10""")
def pending_worklist(spark, sf_dir):
    reg = R.new_registry_rows(_registered(spark, sf_dir))
    return R.pending(reg, 10).select("source_file", "release_id", "source_date")


_RUNLOG_SQL = """
WITH l AS (
  SELECT 's3://""" + _BUCKET + "/" + _PREFIX + """R' || CAST(user_id % 10 AS VARCHAR) || '/2024-01-'
      || lpad(CAST(user_id % 28 + 1 AS VARCHAR), 2, '0') || '.csv' AS source_file,
    event_id AS seq,
    CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'click' THEN 'PROCESSING' WHEN 'purchase' THEN 'SUCCESS'
      WHEN 'error' THEN 'FAILED' ELSE 'RESUMED' END AS status,
    CASE WHEN event_type IN ('error', 'click') THEN ['BRONZE', 'SILVER', 'DQ', 'GOLD'][event_id % 4 + 1] END AS stage,
    CASE WHEN event_type = 'error' THEN 'error ' || CAST(event_id AS VARCHAR) END AS error,
    'run-' || CAST(event_id % 97 AS VARCHAR) AS run_id
  FROM events),
st AS (
  SELECT source_file,
    CASE WHEN arg_max_null(status, seq) = 'RESUMED' THEN 'PROCESSING' ELSE arg_max_null(status, seq) END AS status,
    arg_max_null(stage, seq) AS stage, arg_max_null(run_id, seq) AS run_id, max(seq) AS last_seq,
    CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS failure_count,
    CAST(count(*) FILTER (WHERE status = 'RESUMED') AS BIGINT) AS resume_count,
    arg_max(stage, seq) FILTER (WHERE status = 'FAILED') AS last_failed_stage,
    arg_max(error, seq) FILTER (WHERE status = 'FAILED') AS last_error
  FROM l GROUP BY source_file)
"""


@query("status_rollup", _RUNLOG_SQL + "SELECT * FROM st")
def status_rollup(spark, sf_dir):
    return R.status_rollup(O.events_run_log(spark, sf_dir))


@query("resume_plan", _RUNLOG_SQL + """
SELECT *, list_slice(['BRONZE', 'SILVER', 'DQ', 'GOLD'],
    list_position(['BRONZE', 'SILVER', 'DQ', 'GOLD'], stage), 4) AS stages_to_run, stage AS resume_from
FROM st WHERE status = 'FAILED' AND stage IN ('BRONZE', 'SILVER', 'DQ', 'GOLD')""")
def resume_plan(spark, sf_dir):
    return R.resume_plan(R.status_rollup(O.events_run_log(spark, sf_dir)))
