"""Hot keys: one key holding a third of all rows still gives whole, exact results."""
import datetime as dt
import json

from pyspark.sql import functions as F

from drivelake.operators import registry as R
from drivelake.operators.dedup import dedup_latest

KEY = ["release_id", "snapshot_date", "drive_serial_number"]


def test_dedup_with_a_hot_key(spark):
    n = 30000
    df = (spark.range(n).repartition(8)
          .select(F.lit("R").alias("release_id"), F.lit(dt.date(2024, 1, 1)).alias("snapshot_date"),
                  F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
                  .alias("drive_serial_number"),
                  F.timestamp_seconds(F.col("id")).alias("bronze_ingested_at"),
                  F.lit("f.csv").alias("source_file"), F.col("id").alias("v")))
    out = dedup_latest(df, KEY)
    assert out.count() == 1 + (n - n // 3)          # every cold key kept, the hot key once
    hot = out.filter("drive_serial_number = 'HOT'").collect()
    assert len(hot) == 1 and hot[0]["v"] == max(i for i in range(n) if i % 3 == 0)


def test_registration_with_a_hot_path(spark):
    rows = []
    for i in range(3000):
        key = "raw/drivestats/R/2024-01-01.csv" if i % 3 == 0 else f"raw/drivestats/R/2024-01-{i % 28 + 1:02d}x{i}.csv"
        rec = {"eventName": "put", "eventTime": "t", "s3": {"bucket": {"name": "b"}, "object": {"key": key}}}
        rows.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i),
                     json.dumps({"Records": [{"body": json.dumps({"Records": [rec]})}]})))
    msgs = spark.createDataFrame(rows, "message_id long, received_at timestamp, envelope string").repartition(8)
    acc, _ = R.parse_events(msgs, "b", "raw/drivestats/")
    reg = R.register(acc)
    hot = reg.filter(F.col("source_file").endswith("R/2024-01-01.csv"))
    assert hot.filter("registration = 'NEW'").select("message_id").collect()[0][0] == 0   # first arrival wins
    assert hot.filter("registration = 'DUPLICATE'").count() == 999
