"""Keep-latest on the business key."""
import datetime as dt

from drivelake.operators.dedup import dedup_latest

KEY = ["release_id", "snapshot_date", "drive_serial_number"]
DDL = "release_id string, snapshot_date date, drive_serial_number string, bronze_ingested_at timestamp, " \
      "source_file string, failure_flag int"


def _df(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_latest_ingestion_wins_then_file_then_full_row(spark):
    d = dt.date(2024, 1, 1)
    t1, t2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    rows = [("R", d, "A", t1, "a.csv", 0), ("R", d, "A", t2, "a.csv", 1),      # newer ingestion
            ("R", d, "B", t1, "a.csv", 0), ("R", d, "B", t1, "b.csv", 1),      # same time, later file
            ("R", d, "C", t1, "a.csv", 0), ("R", d, "C", t1, "a.csv", 1),      # tie -> full row order
            ("R", d, "D", t1, "a.csv", 1), ("R", d, "D", t1, "a.csv", 1)]      # identical rows
    out = {r["drive_serial_number"]: r for r in dedup_latest(_df(spark, rows), KEY).collect()}
    assert len(out) == 4
    assert out["A"]["failure_flag"] == 1
    assert out["B"]["source_file"] == "b.csv"
    assert out["C"]["failure_flag"] == 1
    assert out["D"]["failure_flag"] == 1


def test_idempotent_and_key_unique(spark):
    d = dt.date(2024, 1, 1)
    rows = [("R", d, str(i % 5), dt.datetime(2024, 1, 1 + i % 3), f"{i % 2}.csv", i % 2) for i in range(40)]
    once = dedup_latest(_df(spark, rows), KEY)
    twice = dedup_latest(once, KEY)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == once.select(*KEY).distinct().count() == 5
