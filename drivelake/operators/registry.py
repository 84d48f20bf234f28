"""File registry and run log as DataFrame jobs.

Object-created notifications arrive as queue messages whose body is a JSON
object-event document.  Instead of one function call per message against a
key-value store, the messages form a DataFrame (batch or stream):
validation is a column expression that yields the first failing reason,
registration is "first event per path wins" plus an anti-join against the
registry, and run state is an aggregation of an append-only run log.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.functions.paths import decode_key, release_from_key, source_date_from_key, utc_iso

# The envelope layout and the validation messages.
ENVELOPE_SCHEMA = "struct<Records: array<struct<body: string>>>"
OBJECT_EVENT_SCHEMA = (
    "struct<Records: array<struct<eventName: string, eventTime: string, "
    "s3: struct<bucket: struct<name: string>, "
    "object: struct<key: string, size: bigint, eTag: string>>>>>"
)
STAGES = ("BRONZE", "SILVER", "DQ", "GOLD")
FILE_ENTITY = "FILE"
PENDING = "PENDING"
MSG_NO_RECORDS = "SQS event contains no Records."
MSG_NO_BODY = "SQS record missing body."
MSG_BAD_JSON = "SQS body is invalid JSON."
MSG_NO_S3_RECORDS = "S3 event contains no Records."
MSG_NO_S3 = "Missing 's3' object."
MSG_NO_BUCKET = "Missing bucket name."
MSG_NO_KEY = "Missing object key."
MSG_BUCKET = "Unexpected bucket: "
MSG_PREFIX = "Object outside allowed prefix: "
MSG_KEY = "Invalid raw object key: "
MSG_RELEASE = "Unable to determine release_id: "
MSG_CSV = "Expected CSV source file: "
MSG_DATE = "Invalid date filename: "

REGISTRY_COLUMNS = (
    "control_id", "entity_type", "source_file", "bucket", "key", "release_id", "source_date",
    "size_bytes", "etag", "event_name", "event_time", "received_at", "status", "gsi_pk", "gsi_sk",
)


def read_object_events(messages: DataFrame, envelope: str = "envelope") -> DataFrame:
    """Queue messages -> one row per object record (or per broken message).

    Keeps ``message_id`` / ``received_at`` and adds ``record_index``,
    ``message_error`` (message-level reason) and the raw record fields.
    """
    env = F.from_json(F.col(envelope), ENVELOPE_SCHEMA)
    m = messages.withColumn("_env", env).withColumn(
        "_env_ok", F.try_parse_json(F.col(envelope)).isNotNull())
    bodies = m.select("*", F.posexplode_outer("_env.Records").alias("body_index", "_rec"))
    body = F.col("_rec.body")
    parsed = F.from_json(body, OBJECT_EVENT_SCHEMA)
    b = bodies.withColumns({"_body": body, "_s3evt": parsed, "_body_ok": F.try_parse_json(body).isNotNull()})
    msg_error = (
        F.when(~F.col("_env_ok") | (F.coalesce(F.size("_env.Records"), F.lit(0)) <= 0),
               F.lit(MSG_NO_RECORDS))
        .when(F.col("_body").isNull() | (F.col("_body") == ""), F.lit(MSG_NO_BODY))
        .when(~F.col("_body_ok"), F.lit(MSG_BAD_JSON))
        .when(F.coalesce(F.size("_s3evt.Records"), F.lit(0)) <= 0, F.lit(MSG_NO_S3_RECORDS))
    )
    b = b.withColumn("message_error", msg_error)
    recs = b.select("*", F.posexplode_outer(
        F.when(F.col("message_error").isNull(), F.col("_s3evt.Records"))).alias("record_index", "_r"))
    keep = [c for c in messages.columns if c != envelope]
    return recs.select(
        *keep, "body_index", "record_index", "message_error",
        F.col("_r.eventName").alias("event_name"),
        F.col("_r.eventTime").alias("event_time"),
        F.col("_r.s3").alias("_s3"),
        F.col("_r.s3.bucket.name").alias("raw_bucket"),
        F.col("_r.s3.object.key").alias("raw_key"),
        F.col("_r.s3.object.size").alias("size_bytes"),
        F.col("_r.s3.object.eTag").alias("etag"),
    )


def validate(records: DataFrame, bucket: str, prefix: str, scheme: str = "s3") -> DataFrame:
    """First failing reason per record (``reject_reason``), and for good
    records the file metadata (release, source date, source_file URI)."""
    key = decode_key(F.col("raw_key"))
    rel = release_from_key(key, prefix)
    date = source_date_from_key(key)
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    name = F.regexp_extract(key, r"([^/]*)$", 1)
    reason = (
        F.when(F.col("message_error").isNotNull(), F.col("message_error"))
        .when(F.col("_s3").isNull(), F.lit(MSG_NO_S3))
        .when(empty("raw_bucket"), F.lit(MSG_NO_BUCKET))
        .when(empty("raw_key"), F.lit(MSG_NO_KEY))
        .when(F.col("raw_bucket") != F.lit(bucket), F.concat(F.lit(MSG_BUCKET), F.col("raw_bucket")))
        .when(~key.startswith(F.lit(prefix)), F.concat(F.lit(MSG_PREFIX), key))
        .when(F.instr(F.substring(key, len(prefix) + 1, 1 << 30), "/") == 0,
              F.concat(F.lit(MSG_KEY), key))
        .when(rel.isNull(), F.concat(F.lit(MSG_RELEASE), key))
        .when(~name.endswith(F.lit(".csv")), F.concat(F.lit(MSG_CSV), key))
        .when(date.isNull(), F.concat(F.lit(MSG_DATE), name))
    )
    return records.withColumns({
        "bucket": F.col("raw_bucket"),
        "key": key,
        "release_id": rel,
        "source_date": date,
        "source_file": F.concat(F.lit(f"{scheme}://"), F.col("raw_bucket"), F.lit("/"), key),
        "reject_reason": reason,
    }).drop("_s3")


def parse_events(messages: DataFrame, bucket: str, prefix: str, scheme: str = "s3") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) object events; rejects go to a side table
    instead of failing the whole batch."""
    v = validate(read_object_events(messages), bucket, prefix, scheme)
    ok = F.col("reject_reason").isNull()
    return v.filter(ok).drop("reject_reason", "message_error"), v.filter(~ok)


def register(accepted: DataFrame, registry: DataFrame | None = None,
             order: Sequence[str] = ("received_at", "event_time", "message_id", "body_index", "record_index"),
             pending_key: str = "DRIVESTATS#PENDING") -> DataFrame:
    """Label every accepted event NEW or DUPLICATE.

    The path is the key: the first event per ``source_file`` (arrival order)
    is NEW unless the registry already holds the path; every other event is
    DUPLICATE, a re-upload with a new etag included.  NEW rows carry the
    registry record columns.  Order is ascending with NULLs first.
    """
    # First arrival per path as a partial (map-side) aggregate, so a path
    # delivered millions of times is folded before the shuffle; the label is
    # then a key-aligned join back (AQE splits a skewed join partition).
    ord_struct = F.struct(*[F.col(c) for c in order])
    firsts = accepted.groupBy("source_file").agg(F.min(ord_struct).alias("_first_ord"))
    if registry is not None:
        # the paths of this batch filter the registry (a broadcast where they are small), so no registry row is shuffled for itself
        known = registry.select("source_file").join(firsts.select("source_file"), "source_file", "left_semi")
        firsts = firsts.join(known.distinct().withColumn("_known", F.lit(True)), "source_file", "left")
    else:
        firsts = firsts.withColumn("_known", F.lit(None).cast("boolean"))
    first = (accepted.join(firsts, "source_file", "left")
             .withColumn("_first", ord_struct.eqNullSafe(F.col("_first_ord")))
             .withColumn("_known", F.coalesce(F.col("_known"), F.lit(False))))
    # a message delivered twice ties with itself: one of the equal rows is the first
    first = first.withColumn("_first", F.col("_first") & (F.row_number().over(W.partitionBy("source_file", ord_struct).orderBy(F.lit(1))) == 1))
    received_text = utc_iso(F.col("received_at"))  # F17
    return first.withColumns({
        "registration": F.when(F.col("_first") & ~F.col("_known"), "NEW").otherwise("DUPLICATE"),
        "control_id": F.concat(F.lit(f"{FILE_ENTITY}#"), F.col("source_file")),
        "entity_type": F.lit(FILE_ENTITY),
        "status": F.lit(PENDING),
        "gsi_pk": F.lit(pending_key),
        "gsi_sk": F.concat(received_text, F.lit("#"), F.col("source_file")),
    }).drop("_first", "_known", "_first_ord")


def new_registry_rows(registered: DataFrame) -> DataFrame:
    return registered.filter(F.col("registration") == "NEW").select(*REGISTRY_COLUMNS)


def register_counts(registered: DataFrame) -> DataFrame:
    """Processed / new / duplicate counters."""
    return registered.agg(
        F.count(F.lit(1)).cast("long").alias("processed_count"),
        F.count_if(F.col("registration") == "NEW").cast("long").alias("new_count"),
        F.count_if(F.col("registration") == "DUPLICATE").cast("long").alias("duplicate_count"),
    )


def pending(registry: DataFrame, n: int = 1, run_log: DataFrame | None = None) -> DataFrame:
    """The oldest ``n`` PENDING files, ties broken by path (top-k).

    With the run log, files that a run has claimed (any state of theirs is
    logged) are no longer pending, so the worklist drains; failed ones come
    back through ``resume_plan``.
    """
    if run_log is not None:
        registry = registry.join(run_log.select("source_file").distinct(), "source_file", "left_anti")
    return (registry.filter(F.col("status") == PENDING)
            .orderBy(F.col("received_at").asc(), F.col("source_file").asc())
            .limit(n))


def status_rollup(run_log: DataFrame) -> DataFrame:
    """Per file, the latest status (a resume counts as PROCESSING), the
    failure and resume counts and the last failed stage/error.

    One hash aggregation with map-side partial buffers, so a file with a huge
    log is folded before the shuffle.
    """
    failed = F.col("status") == "FAILED"
    seq_if_failed = F.when(failed, F.col("seq"))
    latest = F.max_by(F.col("status"), F.col("seq"))
    return run_log.groupBy("source_file").agg(
        F.when(latest == "RESUMED", "PROCESSING").otherwise(latest).alias("status"),
        F.max_by(F.col("stage"), F.col("seq")).alias("stage"),
        F.max_by(F.col("run_id"), F.col("seq")).alias("run_id"),
        F.max("seq").alias("last_seq"),
        F.count_if(failed).cast("long").alias("failure_count"),
        F.count_if(F.col("status") == "RESUMED").cast("long").alias("resume_count"),
        F.max_by(F.col("stage"), seq_if_failed).alias("last_failed_stage"),
        F.max_by(F.col("error"), seq_if_failed).alias("last_error"),
    )


def resume_plan(status: DataFrame) -> DataFrame:
    """Files whose latest state is FAILED at a known stage, with the
    stages still to run (the failed one onward)."""
    stages = F.array(*[F.lit(s) for s in STAGES])
    pos = F.array_position(stages, F.col("stage"))
    return (status.filter((F.col("status") == "FAILED") & F.col("stage").isin(*STAGES))
            .withColumn("stages_to_run", F.slice(stages, pos.cast("int"), (F.lit(len(STAGES) + 1) - pos).cast("int")))
            .withColumn("resume_from", F.col("stage")))
