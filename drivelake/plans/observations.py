"""Drive observations derived from the driver tables.

The test tables are TPC-H-like; these functions re-read them as raw daily
drive snapshots so every operator runs on data whose volume grows with the
scale factor.  All derivations are column expressions on full tables.

* ``lineitem_bronze``: one observation per line item - release = ship year,
  serial = part key, model = the part's brand (join on part key), failure =
  return flag 'R'.  Clean values, several releases (leap years included).
* ``events_bronze``: one observation per event - serial = user, model from
  the user, with deterministic dirty variants of every text field (blank,
  padded, fractional, exponent, overflow, bad dates) to exercise validation.
* ``pages_messages``: one queue message per web page with an object-created
  record built from the page, including the malformed shapes the validator
  must reject.
* ``events_run_log``: the event stream read as a file-processing run log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.sinks.tables import by_partition, clustered_by_partition
from drivelake.sources.tables import spread_stored

LANDING_BUCKET = "drivestats-landing"
RAW_PREFIX = "raw/drivestats/"
FIRST_RECEIVED = 1706745600  # 2024-02-01T00:00:00Z, arrival of the first message
INGEST_EPOCH = 1767225600  # 2026-01-01T00:00:00Z, base of synthetic ingestion times


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_path(release: Column, day: Column) -> Column:
    return F.concat(F.lit(RAW_PREFIX), release, F.lit("/"), day, F.lit(".csv"))


def lineitem_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped (all-string) observations from lineitem x part."""
    li = spread_stored(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                            "l_returnflag", "l_shipdate"), "l_orderkey", "l_linenumber")
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_brand"))
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    day = F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd")
    release = F.year("l_shipdate").cast("string")
    return j.select(
        day.alias("date"),
        F.col("l_partkey").cast("string").alias("serial_number"),
        F.col("p_brand").alias("model"),
        (F.col("l_orderkey") * 1000).cast("string").alias("capacity_bytes"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("failure"),
        F.col("l_linenumber").cast("string").alias("smart_9_raw"),
        _raw_path(release, day).alias("source_file"),
        release.alias("release_id"),
        F.timestamp_seconds(F.lit(INGEST_EPOCH) + F.col("l_orderkey")).alias("ingested_at"),
        F.lit("backfill-lineitem").alias("processing_run_id"),
    )


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped observations from events, with dirty text variants."""
    e = spread_stored(_t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"), "event_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    day = F.date_format(F.to_date("ts"), "yyyy-MM-dd")
    release = F.concat(F.year("ts").cast("string"), F.lit("_Q"), F.quarter("ts").cast("string"))
    date = (F.when(eid % 97 == 0, F.lit(""))
            .when(eid % 89 == 0, F.concat(F.year("ts").cast("string"), F.lit("-1-"), F.dayofmonth("ts").cast("string")))
            .when(eid % 83 == 0, F.concat(F.lit(" "), day))
            .when(eid % 79 == 0, F.lit(None).cast("string"))
            .otherwise(day))
    serial = (F.when(eid % 101 == 0, F.lit("   "))
              .when(eid % 103 == 0, F.lit(None).cast("string"))
              .when(eid % 61 == 0, F.concat(F.lit(" "), uid.cast("string"), F.lit(" ")))
              .otherwise(uid.cast("string")))
    model = (F.when(eid % 107 == 0, F.lit(""))
             .when(eid % 53 == 0, F.concat(F.lit("  M"), (uid % 7).cast("string")))
             .otherwise(F.concat(F.lit("M"), (uid % 7).cast("string"))))
    capacity = (F.when(eid % 47 == 0, F.lit("abc"))
                .when(eid % 43 == 0, F.lit("1e3"))
                .when(eid % 41 == 0, F.lit("99999999999999999999"))
                .otherwise((uid * 1000000000).cast("string")))
    failure = (F.when(eid % 37 == 0, F.lit("5.9"))
               .when(eid % 31 == 0, F.lit("abc"))
               .when(eid % 29 == 0, F.lit(" 1 "))
               .when(eid % 23 == 0, F.lit(""))
               .when(eid % 19 == 0, F.lit("-0.5"))
               .when(F.col("event_type") == "error", F.lit("1"))
               .otherwise(F.lit("0")))
    smart1 = (F.when(eid % 13 == 0, F.lit(".5"))
              .when(eid % 11 == 0, F.lit("+3"))
              .when(eid % 7 == 0, F.lit("-7.99"))
              .when(eid % 5 == 0, F.lit("99999999999"))
              .otherwise((eid % 200).cast("string")))
    smart194 = F.when(eid % 17 == 0, F.lit("5.")).otherwise((uid % 60).cast("string"))
    return e.select(
        date.alias("date"),
        serial.alias("serial_number"),
        model.alias("model"),
        capacity.alias("capacity_bytes"),
        failure.alias("failure"),
        smart1.alias("smart_1_normalized"),
        (eid * 3600).cast("string").alias("smart_9_raw"),
        smart194.alias("smart_194_raw"),
        _raw_path(release, day).alias("source_file"),
        release.alias("release_id"),
        F.col("ts").alias("ingested_at"),
        F.lit("backfill-events").alias("processing_run_id"),
    )


def write_event_drops(spark: SparkSession, sf_dir: str, folder: str, days=None) -> None:
    """The raw columns of ``events_bronze`` as daily CSV files, ``<folder>/day=<day>/release_id=<release>/*.csv``.

    The layout drifts with the day of the month: as it stands; columns reversed
    and re-cased; without ``smart_194_raw`` but with a ``note`` that holds
    commas, quotes and a line break.  A failure of 5.9 is 1.9 here, as Gold takes
    no release with other flags than 0 and 1.  ``days`` (a condition on the day
    of the month) writes some of the days.
    """
    b = events_bronze(spark, sf_dir).replace("5.9", "1.9", "failure")
    columns = [c for c in b.columns if c not in ("source_file", "release_id", "ingested_at", "processing_run_id")]
    on = F.to_date("ingested_at")  # the event's day, as in its file's name
    b = b.select(*columns, "release_id", F.date_format(on, "yyyy-MM-dd").alias("day"), F.dayofmonth(on).alias("of_month")).where(F.lit(True) if days is None else days)
    rows_of = by_partition(b, ["of_month", "day"])  # an entry per day
    b = b.withColumn("note", F.concat(F.lit('slot "'), F.col("smart_9_raw"), F.lit('",\nrack 1')))
    for drift, own in enumerate((columns, columns[::-1], [*(c for c in columns if c != "smart_194_raw"), "note"])):
        rows = b.where(F.col("of_month") % 3 == drift)
        named = [F.col(c).alias(c.upper() if drift == 1 else c) for c in own]
        held = {(day,): n for (of_month, day), n in rows_of.items() if of_month is not None and of_month % 3 == drift}
        rows = clustered_by_partition(rows.select(*named, "day", "release_id"), ["day"], ["smart_9_raw"], held).drop("_bucket")  # a day of many rows is several files
        (rows.write.mode("append").partitionBy("day", "release_id")
         .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder))


def pages_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages (``message_id, received_at, envelope``) from pages."""
    p = _t(spark, sf_dir, "pages").select("page_id", "url", "html")
    pid = F.col("page_id")
    release = F.concat(F.lit("R"), (pid % 3).cast("string"))
    day = F.concat(F.lit("2024-01-"), F.lpad(((pid % 28) + 1).cast("string"), 2, "0"))
    key = (F.when(pid % 13 == 0, F.concat(F.lit(RAW_PREFIX), release, F.lit("/"), day, F.lit(".json")))
           .when(pid % 13 == 1, F.concat(F.lit(RAW_PREFIX), release, F.lit("/2024-01.csv")))
           .when(pid % 13 == 2, F.concat(F.lit(RAW_PREFIX), day, F.lit(".csv")))
           .when(pid % 13 == 3, F.concat(F.lit("tmp/"), release, F.lit("/"), day, F.lit(".csv")))
           .when(pid % 13 == 4, F.concat(F.lit(RAW_PREFIX), F.lit("Q+"), release, F.lit("%20x/"), day, F.lit(".csv")))
           .when(pid % 13 == 5, F.concat(F.lit(RAW_PREFIX), F.lit("/"), day, F.lit(".csv")))
           .otherwise(F.concat(F.lit(RAW_PREFIX), release, F.lit("/"), day, F.lit(".csv"))))
    bucket = F.when(pid % 11 == 0, F.lit("other-bucket")).otherwise(F.lit(LANDING_BUCKET))
    record = F.struct(
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=pid),
                      "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("eventTime"),
        F.struct(F.struct(bucket.alias("name")).alias("bucket"),
                 F.struct(key.alias("key"), F.length("html").cast("long").alias("size"),
                          F.md5(F.col("url")).alias("eTag")).alias("object")).alias("s3"),
    )
    body = (F.when(pid % 17 == 0, F.lit("not json {"))
            .when(pid % 19 == 0, F.lit('{"Records":[]}'))
            .otherwise(F.to_json(F.struct(F.array(record).alias("Records")))))
    envelope = F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records")))
    return p.select(
        pid.alias("message_id"),
        F.timestamp_seconds(F.lit(FIRST_RECEIVED) + (pid % 500) * 60).alias("received_at"),
        envelope.alias("envelope"),
    )


def events_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file-processing run log from events: event type -> status, id -> seq."""
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    uid, eid = F.col("user_id"), F.col("event_id")
    source_file = F.concat(F.lit(f"s3://{LANDING_BUCKET}/{RAW_PREFIX}R"), (uid % 10).cast("string"),
                           F.lit("/2024-01-"), F.lpad(((uid % 28) + 1).cast("string"), 2, "0"), F.lit(".csv"))
    status = (F.when(F.col("event_type") == "view", "PENDING")
              .when(F.col("event_type") == "click", "PROCESSING")
              .when(F.col("event_type") == "purchase", "SUCCESS")
              .when(F.col("event_type") == "error", "FAILED")
              .otherwise("RESUMED"))
    stage = F.element_at(F.array(*[F.lit(s) for s in ("BRONZE", "SILVER", "DQ", "GOLD")]),
                         ((eid % 4) + 1).cast("int"))
    failed = F.col("event_type") == "error"
    return e.select(
        source_file.alias("source_file"),
        eid.alias("seq"),
        status.alias("status"),
        F.when(failed | (F.col("event_type") == "click"), stage).alias("stage"),
        F.when(failed, F.concat(F.lit("error "), eid.cast("string"))).alias("error"),
        F.concat(F.lit("run-"), (eid % 97).cast("string")).alias("run_id"),
        F.col("ts").alias("at"),
    )
