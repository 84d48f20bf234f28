"""Drifting CSV headers are read by name, not by position."""
import os

from drivelake.sources.raw import check_single_file, find_layouts, raw_drops, read_raw

import pytest


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_drifting_headers(spark, scratch):
    _write(f"{scratch}/2013/2013-04-10.csv", "date,serial_number,model,failure\n2013-04-10,S1,M1,0\n")
    _write(f"{scratch}/2013/2013-04-11.csv",
           "Model,date,serial_number,failure,smart_9_raw\nM2,2013-04-11,S2,1,77\n\n")
    _write(f"{scratch}/2013/2013-04-12 x.csv", "date,serial_number,failure\n2013-04-12,S3,0\n")
    df = read_raw(spark, f"{scratch}/2013")
    rows = {r["serial_number"]: r for r in df.collect()}
    assert rows["S1"]["model"] == "M1" and rows["S1"]["smart_9_raw"] is None
    assert rows["S2"]["model"] == "M2" and rows["S2"]["smart_9_raw"] == "77"
    assert rows["S3"]["model"] is None
    assert rows["S3"]["source_file"].endswith("/2013/2013-04-12 x.csv")
    assert set(dict(df.dtypes).values()) == {"string"}


def test_single_file_guard():
    check_single_file("raw/a/2013-04-10.CSV", "raw/")
    for bad in ("other/a.csv", "raw/*.csv", "raw/a.json"):
        with pytest.raises(ValueError):
            check_single_file(bad, "raw/")


def test_one_read_reader_matches_lazy_reader(spark, scratch):
    _write(f"{scratch}/r/2013-04-10.csv", "date,serial_number,model\n2013-04-10,S1,M1\n")
    _write(f"{scratch}/r/2013-04-11.csv", "model,DATE,serial_number,extra\nM2,2013-04-11,S2,\"a,b\"\n")
    lazy = read_raw(spark, f"{scratch}/r")
    cols = ["date", "serial_number", "model", "extra", "source_file"]
    with raw_drops(spark, f"{scratch}/r") as (once, files):
        assert len(files) == 2
        got = sorted(tuple(r) for r in once.select(*cols).collect())
    assert got == sorted(tuple(r) for r in lazy.select(*cols).collect())
    assert ("2013-04-11", "S2", "M2", "a,b") in [g[:4] for g in got]
    _write(f"{scratch}/r/2013-04-12.csv", "2013-04-12,S3,M3\n")
    with pytest.raises(ValueError, match="without a header"):
        with raw_drops(spark, f"{scratch}/r"):
            pass


def test_first_line_is_the_header_and_every_other_line_is_data(spark, scratch):
    _write(f"{scratch}/h/2013-04-10.csv", "﻿date,serial_number,model\n2013-04-10,S1,date\n2013-04-10,date,M2\n")
    _write(f"{scratch}/h/2013-04-11.csv", "serial_number,model,added\nS3,M3,x\n")  # no date column
    _write(f"{scratch}/h/2013-04-12.csv", "model,Date,serial_number\n")  # header only
    with raw_drops(spark, f"{scratch}/h") as (rows, files):
        got = sorted(tuple(str(x) for x in r) for r in rows.select("date", "serial_number", "model", "added").collect())
        assert len(files) == 3
    assert got == sorted([("2013-04-10", "S1", "date", "None"), ("2013-04-10", "date", "M2", "None"), ("None", "S3", "M3", "x")])


def test_drops_without_a_date_column_reach_the_schema_quarantine(spark, scratch):
    from drivelake.plans.backfill import Lakehouse, run_bronze, run_silver
    _write(f"{scratch}/q/2013/2013-04-10.csv", "serial_number,model\nS1,M1\n")
    lake = Lakehouse(f"{scratch}/lake")
    run_bronze(spark, f"{scratch}/q", "2013", lake, "r1")
    with pytest.raises(ValueError, match="date"):
        run_silver(spark, "2013", lake, "r1")
    assert spark.read.parquet(lake.quarantine.path).count() == 1


def test_an_empty_release_is_named_and_the_others_are_published(spark, scratch):
    from drivelake.plans.backfill import Lakehouse, run_backfill
    head = "date,serial_number,model,capacity_bytes,failure\n"
    _write(f"{scratch}/e/2023/2023-01-01.csv", head + "2023-01-01,S1,M1,100,0\n")
    _write(f"{scratch}/e/2024/2024-01-01.csv", head)
    lake = Lakehouse(f"{scratch}/lake2")
    with pytest.raises(ValueError, match="2024"):
        run_backfill(spark, f"{scratch}/e", lake)
    assert [r[0] for r in spark.read.parquet(lake.gold_release.path).select("release_id").collect()] in (["2023"], [2023])


def test_a_header_is_no_data_however_files_are_split(spark, scratch):
    """The split size changes between planning and execution."""
    rows = [(f"2013-04-{d:02d}", f"S{i}", f"M{i % 3}") for d in range(1, 5) for i in range(300)]
    for d in range(1, 5):
        head = "date,serial_number,model" if d % 2 else "model,serial_number,date"
        own = [r if d % 2 else r[::-1] for r in rows if r[0].endswith(f"{d:02d}")]
        _write(f"{scratch}/s/2013-04-{d:02d}.csv", head + "\n" + "".join(",".join(r) + "\n" for r in own))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for at_plan, at_run in (("1k", "128m"), ("128m", "700")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", at_plan)
            with raw_drops(spark, f"{scratch}/s") as (df, files):
                spark.conf.set("spark.sql.files.maxPartitionBytes", at_run)
                got = sorted(tuple(r) for r in df.select("date", "serial_number", "model").collect())
            assert len(files) == 4 and got == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_breaks_within_quotes_and_blank_first_lines(spark, scratch):
    _write(f"{scratch}/b/2013-04-10.csv", '\n\ndate,serial_number,note\n2013-04-10,S1,"a \\"b\\",\nc"\n2013-04-10,S2,plain\n')
    _write(f"{scratch}/b/[x] {{y}}*.csv", " \n\ndate,serial_number,note\n2013-04-11,S3,\n")
    _write(f"{scratch}/b/nothing.csv", "")
    drops = find_layouts(spark, f"{scratch}/b")
    assert [(x.columns, x.multiline, len(x.files)) for x in drops.layouts] == [
        (("date", "serial_number", "note"), False, 1), (("date", "serial_number", "note"), True, 1)]
    assert len(drops.empty) == 1 and len(drops.files) == 3 and not drops.headless
    got = sorted(tuple(str(x) for x in r) for r in read_raw(spark, f"{scratch}/b").select("date", "serial_number", "note").collect())
    assert got == [("2013-04-10", "S1", 'a "b",\nc'), ("2013-04-10", "S2", "plain"), ("2013-04-11", "S3", "None")]
    _write(f"{scratch}/b/blanks.csv", ' \ndate,serial_number,note\n2013-04-12,S4,"a\nb"\n')  # Spark would take the line of blanks for the header
    assert [f.rsplit("/", 1)[1] for f in find_layouts(spark, f"{scratch}/b").headless] == ["blanks.csv"]


def test_a_file_without_a_header_is_quarantined_and_the_others_are_published(spark, scratch):
    from drivelake.plans.backfill import Lakehouse, run_backfill
    head = "date,serial_number,model,capacity_bytes,failure\n"
    _write(f"{scratch}/n/2023/2023-01-01.csv", head + "2023-01-01,S1,M1,100,0\n")
    _write(f"{scratch}/n/2023/2023-01-02.csv", "2023-01-02,S1,M1,100,0\n2023-01-02,S2,M1,100,1\n")
    _write(f"{scratch}/n/2023/2023-01-03.csv", 'date,"serial\nnumber",model\n2023-01-03,S1,M1\n')
    lake = Lakehouse(f"{scratch}/lake3")
    for _ in range(2):  # a second run leaves the lines of the files once
        with pytest.raises(ValueError, match="2023-01-02.csv"):
            run_backfill(spark, f"{scratch}/n", lake)
    q = spark.read.schema("raw_line string, release_id string, rejection_reason string").parquet(lake.quarantine.path).collect()
    assert sorted(r.raw_line for r in q) == sorted(["2023-01-02,S1,M1,100,0", "2023-01-02,S2,M1,100,1", 'date,"serial', 'number",model', "2023-01-03,S1,M1"])
    assert {(r.release_id, r.rejection_reason) for r in q} == {("2023", "missing_header_line:file")}
    assert [r[0] for r in spark.read.parquet(lake.gold_release.path).select("total_drive_days").collect()] == [1]


def test_release_of_odd_paths_as_by_the_regex(spark):
    """The plain text functions give what the regex gave, and decoding leaves paths without an escape."""
    from pyspark.sql import functions as F

    from drivelake.functions.paths import decode_path
    from drivelake.operators.bronze import release_from_path
    paths = ["a/R1/x.csv", "a/release_id=R1/x.csv", "a/b=c=d/x.csv", "R/x.csv", "x.csv", "/x.csv", "a//x.csv", "a/R/", "a/b=/x.csv", "=q/x", "", None,
             "file:/t/release_id=Q 1/day=2.csv", "a/\n/x.csv", "a/b+c%20d/x%2Bz.csv", "a/100%/x.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    old = F.regexp_extract("p", r"(?:release_id=)?([^/=]+)/[^/]+$", 1)
    assert "regexp" not in df.select(release_from_path(F.col("p")))._jdf.queryExecution().optimizedPlan().toString()
    for a, b in df.select(release_from_path(F.col("p")), old).collect():
        assert a == b
    plain = F.coalesce(F.try_url_decode(F.replace("p", F.lit("+"), F.lit("%2B"))), F.col("p"))
    for a, b in df.select(decode_path("p"), plain).collect():
        assert a == b


def test_a_day_of_many_rows_is_several_files(spark, scratch, monkeypatch):
    """Daily drops grow in number with their rows, and hold the same rows."""
    import datetime as dt
    import glob

    from drivelake.plans import observations as O
    from drivelake.sinks import tables
    from drivelake.sources.raw import read_raw
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3), i % 5, "error" if i % 4 else "view") for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{scratch}/sf/events.parquet")
    O.write_event_drops(spark, f"{scratch}/sf", f"{scratch}/few")
    monkeypatch.setattr(tables, "TASK_ROWS", 20)
    O.write_event_drops(spark, f"{scratch}/sf", f"{scratch}/many")
    few, many = (glob.glob(f"{scratch}/{f}/**/*.csv", recursive=True) for f in ("few", "many"))
    assert len(few) == 3 and len(many) >= 6
    texts = lambda f: sorted(map(str, (tuple(r) for r in read_raw(spark, f"{scratch}/{f}").drop("source_file").collect())))
    assert texts("few") == texts("many") and len(texts("few")) == 300
