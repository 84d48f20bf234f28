"""DuckDB SQL text for the correctness oracle.

Each function returns SQL that recomputes, independently of Spark, what a
``catalogue`` query computes.  Spark-specific semantics are spelled out:
the lenient integral cast (legacy truncating cast), the strict date parse,
blank trimming of spaces only, NULL ordering, and BIGINT sums.
"""

from __future__ import annotations

from drivelake.functions.casts import INTEGER_PART, NUMBER_TEXT
from drivelake.plans.observations import INGEST_EPOCH, RAW_PREFIX
from drivelake.schema import Field, drivestats_fields

_SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
              "string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "float": "FLOAT",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def sql_type(f: Field) -> str:
    return _SQL_TYPES[f.type_name]


def trim_sp(x: str) -> str:
    return f"trim({x}, ' ')"


def lenient(x: str, sqltype: str) -> str:
    t = trim_sp(x)
    whole = f"regexp_extract({t}, '{INTEGER_PART}', 1)"
    return (f"(CASE WHEN regexp_full_match({t}, '{NUMBER_TEXT[1:-1]}') THEN "
            f"try_cast(CASE WHEN {whole} IN ('', '+', '-') THEN '0' ELSE {whole} END AS {sqltype}) END)")


def strict_date(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
            f"THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) END)")


def blank_null(x: str) -> str:
    return f"nullif({trim_sp(x)}, '')"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR {trim_sp(x)} = '')"


def strict_timestamp(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({x}, '%Y-%m-%d') END)"


def value_sql(f: Field) -> str:
    """The field's value by its parse rule."""
    x = f.source_column
    if f.parse in ("date", "timestamp"):
        return strict_date(x) if f.parse == "date" else strict_timestamp(x)
    if f.parse == "text":
        x = blank_null(x)
    if f.type_name in ("int", "bigint", "smallint", "tinyint"):
        return lenient(x, sql_type(f))
    return x if f.type_name == "string" else f"try_cast({x} AS {sql_type(f)})"


def field_sql(f: Field, present: set[str]) -> str:
    if f.source_column not in present:
        return f"CAST(NULL AS {sql_type(f)}) AS {f.name}"
    return f"{value_sql(f)} AS {f.name}"


def reason_sql(fields, present: set[str]) -> str:
    parts = []
    for f in fields:
        if f.nullable or f.source_column not in present:
            continue
        x = f.source_column
        cond = is_blank(x) if f.parse == "text" else f"({is_blank(x)} OR {value_sql(f)} IS NULL)"
        parts.append(f"CASE WHEN {cond} THEN 'invalid_required_field:{f.name}' END")
    if not parts:
        return "CAST(NULL AS VARCHAR)"
    return f"nullif(array_to_string(list_filter([{', '.join(parts)}], lambda z: z IS NOT NULL), ';'), '')"


def candidate_sql(bronze_cte: str, present: set[str], fields=None) -> str:
    """Canonical columns + lineage + _rejection_reason over a bronze CTE."""
    fields = fields or drivestats_fields()
    cols = ",\n  ".join(field_sql(f, present) for f in fields)
    return (f"SELECT {cols},\n  release_id, source_file, ingested_at,\n"
            f"  {reason_sql(fields, present)} AS _rejection_reason\nFROM {bronze_cte}")


# ---------------------------------------------------------------- observations

def lineitem_bronze() -> str:
    day = "strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')"
    rel = "CAST(year(l_shipdate) AS VARCHAR)"
    return f"""SELECT {day} AS date,
  CAST(l_partkey AS VARCHAR) AS serial_number,
  p_brand AS model,
  CAST(l_orderkey * 1000 AS VARCHAR) AS capacity_bytes,
  CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS failure,
  CAST(l_linenumber AS VARCHAR) AS smart_9_raw,
  '{RAW_PREFIX}' || {rel} || '/' || {day} || '.csv' AS source_file,
  {rel} AS release_id,
  {INGEST_EPOCH} + l_orderkey AS ingested_at,
  'backfill-lineitem' AS processing_run_id
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""


LINEITEM_COLUMNS = {"date", "serial_number", "model", "capacity_bytes", "failure", "smart_9_raw"}
EVENTS_COLUMNS = {"date", "serial_number", "model", "capacity_bytes", "failure", "smart_1_normalized",
                  "smart_9_raw", "smart_194_raw"}


def events_bronze() -> str:
    day = "strftime(CAST(ts AS DATE), '%Y-%m-%d')"
    rel = "CAST(year(ts) AS VARCHAR) || '_Q' || CAST(quarter(ts) AS VARCHAR)"
    return f"""SELECT
  CASE WHEN event_id % 97 = 0 THEN ''
       WHEN event_id % 89 = 0 THEN CAST(year(ts) AS VARCHAR) || '-1-' || CAST(day(ts) AS VARCHAR)
       WHEN event_id % 83 = 0 THEN ' ' || {day}
       WHEN event_id % 79 = 0 THEN NULL
       ELSE {day} END AS date,
  CASE WHEN event_id % 101 = 0 THEN '   '
       WHEN event_id % 103 = 0 THEN NULL
       WHEN event_id % 61 = 0 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
       ELSE CAST(user_id AS VARCHAR) END AS serial_number,
  CASE WHEN event_id % 107 = 0 THEN ''
       WHEN event_id % 53 = 0 THEN '  M' || CAST(user_id % 7 AS VARCHAR)
       ELSE 'M' || CAST(user_id % 7 AS VARCHAR) END AS model,
  CASE WHEN event_id % 47 = 0 THEN 'abc'
       WHEN event_id % 43 = 0 THEN '1e3'
       WHEN event_id % 41 = 0 THEN '99999999999999999999'
       ELSE CAST(user_id * 1000000000 AS VARCHAR) END AS capacity_bytes,
  CASE WHEN event_id % 37 = 0 THEN '5.9'
       WHEN event_id % 31 = 0 THEN 'abc'
       WHEN event_id % 29 = 0 THEN ' 1 '
       WHEN event_id % 23 = 0 THEN ''
       WHEN event_id % 19 = 0 THEN '-0.5'
       WHEN event_type = 'error' THEN '1'
       ELSE '0' END AS failure,
  CASE WHEN event_id % 13 = 0 THEN '.5'
       WHEN event_id % 11 = 0 THEN '+3'
       WHEN event_id % 7 = 0 THEN '-7.99'
       WHEN event_id % 5 = 0 THEN '99999999999'
       ELSE CAST(event_id % 200 AS VARCHAR) END AS smart_1_normalized,
  CAST(event_id * 3600 AS VARCHAR) AS smart_9_raw,
  CASE WHEN event_id % 17 = 0 THEN '5.' ELSE CAST(user_id % 60 AS VARCHAR) END AS smart_194_raw,
  '{RAW_PREFIX}' || {rel} || '/' || {day} || '.csv' AS source_file,
  {rel} AS release_id,
  ts AS ingested_at,
  'backfill-events' AS processing_run_id
FROM events"""


def events_landed() -> str:
    """``events_bronze`` as it is read from daily CSV files: an empty field is NULL, no failure is 5.9,
    a third of the days have no smart_194_raw, and there is one ingestion time."""
    blank = ", ".join(f"nullif({c}, '') AS {c}" for c in sorted(EVENTS_COLUMNS - {"smart_194_raw", "failure"}))
    return f"""SELECT * REPLACE ({blank}, CASE failure WHEN '' THEN NULL WHEN '5.9' THEN '1.9' ELSE failure END AS failure,
  CASE WHEN day(ingested_at) % 3 = 2 THEN NULL ELSE smart_194_raw END AS smart_194_raw,
  TIMESTAMP '2026-01-01 00:00:00' AS ingested_at) FROM ({events_bronze()}) e"""


def silver_sql(bronze_cte: str, present: set[str], run_id: str, order_rest: list[str]) -> str:
    """Accepted, stamped, keep-latest rows (all candidate columns)."""
    rest = "".join(f", {c} DESC NULLS LAST" for c in order_rest)
    return f"""SELECT * EXCLUDE (_rejection_reason, _rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY release_id, snapshot_date, drive_serial_number
      ORDER BY ingested_at DESC NULLS LAST, source_file DESC NULLS LAST{rest}) AS _rn
  FROM ({candidate_sql(bronze_cte, present)}) c
  WHERE _rejection_reason IS NULL) d
WHERE _rn = 1"""


# Non-constant candidate columns after the key and the fixed order, in name
# order (the Spark tie-break order); constant or all-NULL columns cannot
# change an order and are left out.
LINEITEM_REST = ["capacity_bytes", "drive_model", "failure_flag", "smart_9_raw"]
EVENTS_REST = ["capacity_bytes", "drive_model", "failure_flag", "smart_194_raw", "smart_1_normalized", "smart_9_raw"]


def with_views(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items()) + "\n"


def lineitem_silver_with() -> str:
    return with_views(li_bronze=lineitem_bronze(),
                      li_silver=silver_sql("li_bronze", LINEITEM_COLUMNS, "", LINEITEM_REST))


def events_silver_with() -> str:
    return with_views(ev_bronze=events_bronze(),
                      ev_silver=silver_sql("ev_bronze", EVENTS_COLUMNS, "", EVENTS_REST))


def afr_sql(failures: str, days: str, first_date: str) -> str:
    yd = f"CAST(dayofyear(make_date(year({first_date}), 12, 31)) AS DOUBLE)"
    return (f"CASE WHEN {days} > 0 THEN CAST({failures} AS DOUBLE) / (CAST({days} AS DOUBLE) / {yd}) "
            f"* CAST(100.0 AS DOUBLE) END")


def release_metrics_sql(src: str) -> str:
    f, d = "CAST(sum(failure_flag) AS BIGINT)", "CAST(count(*) AS BIGINT)"
    return f"""SELECT release_id, min(snapshot_date) AS start_date, max(snapshot_date) AS end_date,
  CAST(count(DISTINCT snapshot_date) AS BIGINT) AS distinct_snapshot_dates,
  CAST(count(DISTINCT drive_serial_number) AS BIGINT) AS distinct_drives,
  CAST(count(DISTINCT drive_model) AS BIGINT) AS distinct_models,
  {d} AS total_drive_days, {f} AS drive_failures,
  {afr_sql(f, d, 'min(snapshot_date)')} AS annualized_failure_rate_pct
FROM {src} GROUP BY release_id"""


def model_metrics_sql(src: str) -> str:
    f, d = "CAST(sum(failure_flag) AS BIGINT)", "CAST(count(*) AS BIGINT)"
    return f"""SELECT release_id, drive_model,
  CAST(count(DISTINCT drive_serial_number) AS BIGINT) AS distinct_drives,
  {d} AS total_drive_days, {f} AS drive_failures,
  {afr_sql(f, d, 'min(snapshot_date)')} AS annualized_failure_rate_pct,
  min(snapshot_date) AS first_snapshot_date, max(snapshot_date) AS last_snapshot_date
FROM {src} GROUP BY release_id, drive_model"""
