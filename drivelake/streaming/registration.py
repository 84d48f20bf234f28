"""Object-event registration as a stream (S8, R1-R4 over micro-batches).

Queue messages arrive as a streaming DataFrame (``message_id``,
``received_at``, ``envelope``); every micro-batch is validated, rejects are
appended to a side table, and accepted events are registered against the
registry table - the first event per path is NEW unless the registry already
holds it.  A replayed micro-batch finds its own NEW rows in the registry and
labels them DUPLICATE, so registration is idempotent without stream state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from drivelake.operators import registry as R
from drivelake.sinks.tables import append
from drivelake.sources.tables import Table, read_table, table_exists

REGISTRY_SCHEMA = T.StructType([
    T.StructField("control_id", T.StringType()), T.StructField("entity_type", T.StringType()),
    T.StructField("source_file", T.StringType()), T.StructField("bucket", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("release_id", T.StringType()),
    T.StructField("source_date", T.StringType()), T.StructField("size_bytes", T.LongType()),
    T.StructField("etag", T.StringType()), T.StructField("event_name", T.StringType()),
    T.StructField("event_time", T.StringType()), T.StructField("received_at", T.TimestampType()),
    T.StructField("status", T.StringType()), T.StructField("gsi_pk", T.StringType()),
    T.StructField("gsi_sk", T.StringType()),
])


def register_batch(spark: SparkSession, messages: DataFrame, registry: Table, rejects: Table,
                   bucket: str, prefix: str) -> dict:
    """One micro-batch: validate, side-table the rejects, append NEW files.
    Returns the R4 counters."""
    accepted, rejected = R.parse_events(messages, bucket, prefix)
    known = read_table(spark, registry) if table_exists(spark, registry) else None
    registered = R.register(accepted, known).cache()
    try:
        counts = R.register_counts(registered).collect()[0].asDict()
        bad = rejected.select("message_id", "record_index", "reject_reason", "raw_bucket", "raw_key")
        if table_exists(spark, rejects):  # a replayed micro-batch finds its rejects there
            seen = spark.read.schema(bad.schema).parquet(rejects.path).select(F.col("message_id").alias("_m"), F.col("record_index").alias("_i")).distinct()
            bad = bad.join(seen, F.col("message_id").eqNullSafe(F.col("_m")) & F.col("record_index").eqNullSafe(F.col("_i")), "left_anti")
        if not bad.isEmpty():
            append(bad, rejects)
        if counts["new_count"]:
            append(R.new_registry_rows(registered), registry)
    finally:
        registered.unpersist()
    return counts


def run_registration(spark: SparkSession, messages: DataFrame, registry: Table, rejects: Table,
                     bucket: str, prefix: str, checkpoint: str) -> StreamingQuery:
    """Start the registration stream over a streaming messages DataFrame."""
    def body(batch: DataFrame, epoch_id: int) -> None:
        register_batch(spark, batch, registry, rejects, bucket, prefix)

    return (messages.writeStream.foreachBatch(body)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
