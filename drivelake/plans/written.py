"""Registered queries over what the jobs write: landed files, streams, tables.

Each query writes to a new folder under the session's shared folder, by the
same functions that a deployment calls, and returns what it reads back.  The
SQL recomputes that from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.operators import bronze as B
from drivelake.operators import registry as R
from drivelake.plans import observations as O
from drivelake.plans import oracle as X
from drivelake.plans.backfill import Lakehouse, run_gold, run_silver
from drivelake.plans.catalogue import _BUCKET, _ORDERS_GEN, _PREFIX, _REGISTER_SQL, ORACLE, QUERIES, RUN_ID, _orders_generations, _t, query  # noqa: F401
from drivelake.sinks.tables import append, create_or_append, create_table, overwrite_partitions, upsert
from drivelake.sources.raw import read_raw
from drivelake.sources.tables import Table, read_table
from drivelake.streaming.incremental import RUN_LOG_SCHEMA, run_incremental
from drivelake.streaming.registration import REGISTRY_SCHEMA, register_batch
from drivelake.util import scratch_path

RAW_COLUMNS = sorted(X.EVENTS_COLUMNS)
SILVER_COLUMNS = ["release_id", "snapshot_date", "drive_serial_number", "drive_model", "capacity_bytes", "failure_flag",
                  "smart_1_normalized", "smart_9_raw", "smart_194_raw", "snapshot_month"]
GOLD_COLUMNS = ["release_id", "drive_model", "distinct_drives", "total_drive_days", "drive_failures",
                "annualized_failure_rate_pct", "first_snapshot_date", "last_snapshot_date"]


# ------------------------------------------------------------------ landed files

@query("csv_layouts", f"""
WITH b AS ({X.events_landed()})
SELECT {", ".join(RAW_COLUMNS)}, release_id,
  CASE WHEN CAST(regexp_extract(source_file, '(\\d+).csv$', 1) AS INTEGER) % 3 = 2
       THEN 'slot "' || smart_9_raw || '",' || chr(10) || 'rack 1' END AS note
FROM b""")
def csv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily CSV files of three layouts, read by header."""
    folder = scratch_path(spark, "drops")
    O.write_event_drops(spark, sf_dir, folder)
    raw = read_raw(spark, folder)
    return raw.select(*RAW_COLUMNS, B.release_from_path(F.col("source_file")).alias("release_id"), "note")


def _streamed(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Three streams over one landing folder: some days, then the others with two late ones, then all once more."""
    landing, lake = scratch_path(spark, "landing"), Lakehouse(scratch_path(spark, "lake"))
    late = F.col("of_month").isin(7, 15) | (F.col("of_month") > 20)
    first, again = scratch_path(spark, "stream"), scratch_path(spark, "replay")
    for days, checkpoint in ((~late, first), (late, first), (None, again)):  # a new checkpoint delivers every file again
        if days is not None:
            O.write_event_drops(spark, sf_dir, landing, days)
        stream = run_incremental(spark, landing, lake, checkpoint, max_files=1000)
        stream.awaitTermination()
        if stream.exception():
            raise stream.exception()
    return lake


_LANDED = X.with_views(ev_landed=X.events_landed(), ev_silver=X.silver_sql("ev_landed", X.EVENTS_COLUMNS, "", X.EVENTS_REST))


@query("stream_files", _LANDED + f"""
SELECT * EXCLUDE (snapshot_month), strftime(snapshot_date, '%Y-%m') AS snapshot_month
FROM (SELECT *, NULL AS snapshot_month FROM (SELECT {", ".join(SILVER_COLUMNS[:-1])} FROM ev_silver) s) t""")
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after late files and a replay."""
    return read_table(spark, _streamed(spark, sf_dir).silver).select(*SILVER_COLUMNS)


@query("stream_gold", _LANDED + X.model_metrics_sql("ev_silver"))
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after late files and a replay."""
    return read_table(spark, _streamed(spark, sf_dir).gold_model).select(*GOLD_COLUMNS)


# ------------------------------------------------------------------ layer tables

def _silver_twice(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Bronze of events, then the Silver job two times."""
    lake = Lakehouse(scratch_path(spark, "lake"))
    B.write_bronze(spark, O.events_bronze(spark, sf_dir), lake.bronze)
    for _ in range(2):
        run_silver(spark, "2024_Q1", lake, RUN_ID)
    return lake


_IN_Q1 = X.with_views(ev_all=X.events_bronze(), ev_bronze="SELECT * FROM ev_all WHERE release_id = '2024_Q1'")
_SILVER_Q1 = _IN_Q1.rstrip() + ",\nev_silver AS (" + X.silver_sql("ev_bronze", X.EVENTS_COLUMNS, "", X.EVENTS_REST) + ")\n"


@query("silver_table", _SILVER_Q1 + f"""SELECT {", ".join(SILVER_COLUMNS[:-1])}, source_file,
  strftime(snapshot_date, '%Y-%m') AS snapshot_month FROM ev_silver""")
def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: the Silver table after the job ran two times."""
    return read_table(spark, _silver_twice(spark, sf_dir).silver).select(*SILVER_COLUMNS, "source_file")


@query("quarantine_table", _IN_Q1.rstrip() + ",\nc AS (" + X.candidate_sql("ev_bronze", X.EVENTS_COLUMNS) + """)
SELECT snapshot_date, drive_serial_number, drive_model, failure_flag, release_id, source_file,
  _rejection_reason AS rejection_reason FROM c WHERE _rejection_reason IS NOT NULL""")
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine table after the job ran two times holds every row once."""
    return read_table(spark, _silver_twice(spark, sf_dir).quarantine).select(
        "snapshot_date", "drive_serial_number", "drive_model", "failure_flag", "release_id", "source_file", "rejection_reason")


@query("gold_table", X.lineitem_silver_with() + X.model_metrics_sql("li_silver"))
def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of all releases published two times, read back."""
    lake = Lakehouse(scratch_path(spark, "lake"))
    B.write_bronze(spark, O.lineitem_bronze(spark, sf_dir), lake.bronze)
    releases = [r[0] for r in read_table(spark, lake.bronze).select("release_id").distinct().collect()]  # a row per release
    run_silver(spark, releases, lake, RUN_ID)
    for _ in range(2):
        run_gold(spark, releases, lake, RUN_ID)
    return read_table(spark, lake.gold_model).select(*GOLD_COLUMNS)


# ------------------------------------------------------------------ tables by themselves

@query("upsert_table", _ORDERS_GEN + """
SELECT * FROM gen1 WHERE NOT EXISTS (
  SELECT 1 FROM gen2 WHERE gen2.order_key = gen1.order_key AND gen2.release_id = gen1.release_id)
UNION ALL SELECT * FROM gen2""")
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of orders, the second one two times."""
    table = Table(scratch_path(spark, "orders"), ("release_id",))
    gen1, gen2 = _orders_generations(spark, sf_dir)
    for rows in (gen1, gen2, gen2):
        upsert(spark, rows, table, ["release_id", "order_key"], cluster_by=("release_id",))
    return read_table(spark, table).select(*gen1.columns)


@query("evolving_table", """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
  CAST(NULL AS VARCHAR) AS mktsegment, CAST(NULL AS BIGINT) AS regionkey, 'supplier' AS origin FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, NULL, c_mktsegment, NULL, 'customer' FROM customer
UNION ALL SELECT n_nationkey, n_name, NULL, NULL, NULL, n_regionkey, 'nation' FROM nation""")
def evolving_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations, with new, missing and re-cased columns."""
    table = Table(scratch_path(spark, "parties"), ("origin",))
    sup, cust, nation = (_t(spark, sf_dir, t) for t in ("supplier", "customer", "nation"))
    create_or_append(spark, sup.select(F.col("s_suppkey").cast("long").alias("key"), F.col("s_name").alias("name"),
                                       F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                                       F.lit("supplier").alias("origin")), table)
    create_or_append(spark, cust.select(F.col("c_mktsegment").alias("mktsegment"), F.col("c_name").alias("NAME"), F.col("c_custkey").alias("Key"),
                                        F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("origin")), table)
    create_or_append(spark, nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
                                          F.col("n_regionkey").cast("long").alias("regionkey"), F.lit("nation").alias("origin")), table)
    return read_table(spark, table)


@query("overwrite_table", """
SELECT o_orderkey AS order_key, CASE WHEN year(o_orderdate) IN (1996, 1997) THEN -o_totalprice ELSE o_totalprice END AS amount,
  CAST(year(o_orderdate) AS VARCHAR) AS release_id FROM orders
WHERE year(o_orderdate) NOT IN (1996, 1997) OR o_orderstatus = 'F'""")
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: two partitions replaced, the others as they were."""
    table = Table(scratch_path(spark, "yearly"), ("release_id",))
    orders = _t(spark, sf_dir, "orders").withColumn("release_id", F.year("o_orderdate").cast("string"))
    rows = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("amount"), "release_id")
    create_table(rows, table)
    restated = orders.where(F.col("release_id").isin("1996", "1997") & (F.col("o_orderstatus") == "F"))
    for _ in range(2):
        overwrite_partitions(restated.select(F.col("o_orderkey").alias("order_key"), (-F.col("o_totalprice")).alias("amount"), "release_id"), table)
    return read_table(spark, table).select("order_key", "amount", "release_id")


# ------------------------------------------------------------------ registry

def _registered_in_two(spark: SparkSession, sf_dir: str) -> Table:
    """All messages in two batches by arrival; the second meets the stored first, and comes two times."""
    folder = scratch_path(spark, "registry")
    registry, rejects = Table(f"{folder}/files", (), REGISTRY_SCHEMA), Table(f"{folder}/rejects")
    messages = O.pages_messages(spark, sf_dir)
    early = F.col("received_at") < F.timestamp_seconds(F.lit(O.FIRST_RECEIVED + 250 * 60))
    for batch in (messages.where(early), messages.where(~early), messages.where(~early)):
        register_batch(spark, batch, registry, rejects, _BUCKET, _PREFIX)
    return registry


@query("registry_table", _REGISTER_SQL + """
SELECT 'FILE#' || source_file AS control_id, source_file, release_id, source_date, size_bytes, etag, 'PENDING' AS status,
  strftime(received_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z#' || source_file AS gsi_sk FROM r WHERE rn = 1""")
def registry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration against the stored registry."""
    return read_table(spark, _registered_in_two(spark, sf_dir)).select(
        "control_id", "source_file", "release_id", "source_date", "size_bytes", "etag", "status", "gsi_sk")


@query("worklist_after_runs", _REGISTER_SQL + """
SELECT source_file, release_id, source_date FROM r
WHERE rn = 1 AND NOT (release_id = 'R1' AND source_date < '2024-01-15')
ORDER BY received_at, source_file LIMIT 10""")
def worklist_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that a run has claimed have left the worklist."""
    files = read_table(spark, _registered_in_two(spark, sf_dir))
    log = Table(scratch_path(spark, "run-log"), (), RUN_LOG_SCHEMA)
    claimed = files.where((F.col("release_id") == "R1") & (F.col("source_date") < "2024-01-15"))
    append(claimed.select("source_file", F.lit(1).cast("long").alias("seq"), F.lit("PROCESSING").alias("status"), F.lit(None).cast("string").alias("stage"),
                          F.lit(None).cast("string").alias("error"), F.lit(RUN_ID).alias("run_id"), F.col("received_at").alias("at")), log)
    return R.pending(files, 10, read_table(spark, log)).select("source_file", "release_id", "source_date")
