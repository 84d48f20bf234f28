"""Object events, registration, worklist, run log."""
import datetime as dt
import json

from drivelake.operators import registry as R

B, P = "landing", "raw/drivestats/"


def _msg(mid, key, bucket=B, etag="e1", minute=0):
    rec = {"eventName": "ObjectCreated:Put", "eventTime": "2024-01-01T00:00:00.000Z",
           "s3": {"bucket": {"name": bucket}, "object": {"key": key, "size": 10, "eTag": etag}}}
    env = {"Records": [{"body": json.dumps({"Records": [rec]})}]}
    return (mid, dt.datetime(2024, 2, 1, 0, minute), json.dumps(env))


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "message_id long, received_at timestamp, envelope string")


def test_validation_reasons(spark):
    rows = [_msg(1, P + "2013/2013-04-10.csv"), _msg(2, P + "2013/2013-04-10.csv", bucket="other"),
            _msg(3, "tmp/2013/2013-04-10.csv"), _msg(4, P + "2013/2013-04-10.json"),
            _msg(5, P + "2013/2013-04.csv"), _msg(6, P + "2013-04-10.csv"),
            _msg(7, P + "Q+1%20x/2013-04-11.csv"),
            (8, dt.datetime(2024, 2, 1), '{"Records":[{"body":"not json"}]}'),
            (9, dt.datetime(2024, 2, 1), '{"Records":[]}'),
            (10, dt.datetime(2024, 2, 1), '{"Records":[{"body":"{\\"Records\\":[]}"}]}')]
    v = {r["message_id"]: r for r in R.validate(R.read_object_events(_msgs(spark, rows)), B, P).collect()}
    assert v[1]["reject_reason"] is None and v[1]["release_id"] == "2013" and v[1]["source_date"] == "2013-04-10"
    assert v[1]["source_file"] == f"s3://{B}/{P}2013/2013-04-10.csv"
    assert v[2]["reject_reason"] == "Unexpected bucket: other"
    assert v[3]["reject_reason"].startswith("Object outside allowed prefix")
    assert v[4]["reject_reason"].startswith("Expected CSV source file")
    assert v[5]["reject_reason"].startswith("Invalid date filename")
    assert v[6]["reject_reason"].startswith("Invalid raw object key")
    assert v[7]["reject_reason"] is None and v[7]["release_id"] == "Q 1 x"
    assert v[8]["reject_reason"] == "SQS body is invalid JSON."
    assert v[9]["reject_reason"] == "SQS event contains no Records."
    assert v[10]["reject_reason"] == "S3 event contains no Records."


def test_register_first_wins_and_counts(spark):
    rows = [_msg(1, P + "2013/2013-04-10.csv", minute=1), _msg(2, P + "2013/2013-04-10.csv", etag="e2", minute=2),
            _msg(3, P + "2013/2013-04-11.csv", minute=0), _msg(4, P + "2013/2013-04-12.csv", minute=3)]
    acc, rej = R.parse_events(_msgs(spark, rows), B, P)
    assert rej.count() == 0
    registry = R.new_registry_rows(R.register(acc.filter("message_id = 4")))
    reg = {r["message_id"]: r["registration"] for r in R.register(acc, registry).collect()}
    assert reg == {1: "NEW", 2: "DUPLICATE", 3: "NEW", 4: "DUPLICATE"}
    c = R.register_counts(R.register(acc)).collect()[0]
    assert (c.processed_count, c.new_count, c.duplicate_count) == (4, 3, 1)
    top = [r["source_file"] for r in R.pending(R.new_registry_rows(R.register(acc)), 2).collect()]
    assert top == [f"s3://{B}/{P}2013/2013-04-11.csv", f"s3://{B}/{P}2013/2013-04-10.csv"]


def test_status_rollup_and_resume(spark):
    log = [("f1", 1, "PENDING", None, None, "r1"), ("f1", 2, "PROCESSING", None, None, "r1"),
           ("f1", 3, "SUCCESS", None, None, "r1"),
           ("f2", 1, "PROCESSING", None, None, "r1"), ("f2", 2, "FAILED", "SILVER", "boom", "r1"),
           ("f3", 1, "FAILED", "DQ", "bad", "r1"), ("f3", 2, "RESUMED", "DQ", None, "r2"),
           ("f4", 1, "PENDING", None, None, "r1")]
    df = spark.createDataFrame(log, "source_file string, seq long, status string, stage string, error string, run_id string")
    st = {r["source_file"]: r for r in R.status_rollup(df).collect()}
    assert st["f1"]["status"] == "SUCCESS" and st["f2"]["status"] == "FAILED"
    assert st["f3"]["status"] == "PROCESSING" and st["f3"]["resume_count"] == 1 and st["f3"]["failure_count"] == 1
    assert st["f3"]["last_failed_stage"] == "DQ" and st["f4"]["status"] == "PENDING"
    plan = {r["source_file"]: r["stages_to_run"] for r in R.resume_plan(R.status_rollup(df)).collect()}
    assert plan == {"f2": ["SILVER", "DQ", "GOLD"]}


def test_registration_stream_is_replay_safe(spark, scratch):
    import os
    from drivelake.sources.tables import Table, read_table
    from drivelake.streaming.registration import register_batch, run_registration
    rows = [_msg(1, P + "2013/2013-04-10.csv", minute=1), _msg(2, P + "2013/2013-04-10.csv", etag="e2", minute=2),
            _msg(3, P + "2013/2013-04-11.csv"), _msg(4, "tmp/x.csv")]
    landing = f"{scratch}/messages"
    _msgs(spark, rows).write.parquet(landing)
    registry, rejects = Table(f"{scratch}/registry"), Table(f"{scratch}/rejects")
    stream = spark.readStream.schema("message_id long, received_at timestamp, envelope string").parquet(landing)
    q = run_registration(spark, stream, registry, rejects, B, P, f"{scratch}/ckpt")
    q.awaitTermination(120)
    assert q.exception() is None
    files = sorted(r["source_file"] for r in read_table(spark, registry).collect())
    assert files == [f"s3://{B}/{P}2013/2013-04-10.csv", f"s3://{B}/{P}2013/2013-04-11.csv"]
    assert read_table(spark, rejects).count() == 1
    # a replayed batch registers nothing new
    counts = register_batch(spark, _msgs(spark, rows), registry, rejects, B, P)
    assert (counts["processed_count"], counts["new_count"], counts["duplicate_count"]) == (3, 0, 3)
    assert read_table(spark, registry).count() == 2


def test_a_message_delivered_twice_registers_its_file_once(spark):
    row = _msg(1, P + "2013/2013-04-10.csv", minute=1)
    acc, _ = R.parse_events(_msgs(spark, [row, row, row]), B, P)
    labels = sorted(r["registration"] for r in R.register(acc).collect())
    assert labels == ["DUPLICATE", "DUPLICATE", "NEW"]


def test_the_worklist_drains(spark):
    rows = [_msg(i, P + f"2013/2013-04-1{i}.csv", minute=i) for i in range(4)]
    acc, _ = R.parse_events(_msgs(spark, rows), B, P)
    registry = R.new_registry_rows(R.register(acc))
    first = R.pending(registry, 1).collect()[0]["source_file"]
    log = spark.createDataFrame([(first, 1, "PROCESSING"), (first, 2, "SUCCESS")], "source_file string, seq long, status string")
    left = [r["source_file"] for r in R.pending(registry, 9, log).collect()]
    assert first not in left and len(left) == 3
