"""Path-backed tables, upsert and partition overwrite."""
import pytest
from pyspark.sql import functions as F

from drivelake.sinks.tables import align, append_merging, create_table, evolve, newest_generation, overwrite_partitions, upsert
from drivelake.sources.tables import Table, read_table, store_schema, stored_schema, table_exists

DDL = "release_id string, snapshot_month string, k string, v int"
KEYS = ["release_id", "k"]


def _rows(t):
    return sorted(tuple(r) for r in t.select("release_id", "snapshot_month", "k", "v").collect())


def test_upsert_twice_equals_once_and_other_release_untouched(spark, scratch):
    t = Table(f"{scratch}/silver", ("release_id", "snapshot_month"))
    base = spark.createDataFrame([("2013", "2013-01", "a", 1), ("2013", "2013-01", "b", 1),
                                  ("2024_Q1", "2024-01", "a", 1)], DDL)
    upsert(spark, base, t, KEYS)
    assert table_exists(spark, t)
    batch = spark.createDataFrame([("2013", "2013-01", "b", 2), ("2013", "2013-01", "c", 2)], DDL)
    upsert(spark, batch, t, KEYS)
    once = _rows(read_table(spark, t))
    upsert(spark, batch, t, KEYS)
    twice = _rows(read_table(spark, t))
    assert once == twice == [("2013", "2013-01", "a", 1), ("2013", "2013-01", "b", 2),
                             ("2013", "2013-01", "c", 2), ("2024_Q1", "2024-01", "a", 1)]
    # numeric-looking release ids stay strings
    assert dict(read_table(spark, t).dtypes)["release_id"] == "string"


def test_overwrite_partitions_only_touched(spark, scratch):
    t = Table(f"{scratch}/gold", ("release_id",))
    df = spark.createDataFrame([("1996", "x", 1), ("1997", "x", 1)], "release_id string, m string, n int")
    create_table(df, t)
    overwrite_partitions(spark.createDataFrame([("1996", "y", 5)], "release_id string, m string, n int"), t)
    got = sorted(tuple(r) for r in read_table(spark, t).select("release_id", "m", "n").collect())
    assert got == [("1996", "y", 5), ("1997", "x", 1)]


def test_evolve_align_and_append_merging(spark, scratch):
    t = Table(f"{scratch}/bronze", ("release_id",))
    create_table(spark.createDataFrame([("1", "R")], "a string, release_id string"), t)
    new = spark.createDataFrame([("2", "x", "R")], "a string, B string, release_id string")
    assert evolve(read_table(spark, t).schema, new.columns) == ["B"]
    assert evolve(read_table(spark, t).schema, ["A", "release_id"]) == []
    append_merging(spark, new, t)
    rows = sorted(tuple(r) for r in read_table(spark, t).select("a", "B").collect())
    assert rows == [("1", None), ("2", "x")]   # old rows read NULL for the new column
    aligned = align(spark.createDataFrame([(5, "q")], "v long, extra string"),
                    spark.createDataFrame([], "v int, w string").schema)
    assert aligned.dtypes == [("v", "int"), ("w", "string")] and aligned.collect()[0]["w"] is None


def test_stored_schema_spares_the_footers(spark, scratch):
    t = Table(f"{scratch}/evolving", ("release_id",))
    create_table(spark.createDataFrame([("1", "2013")], "a string, release_id string"), t)
    append_merging(spark, spark.createDataFrame([("2", "x", "2014")], "A string, b string, release_id string"), t)
    append_merging(spark, spark.createDataFrame([("y", 3, "2015")], "b string, c int, release_id string"), t)
    append_merging(spark, spark.createDataFrame([("4", "2016")], "a string, release_id string"), t)
    assert stored_schema(spark, t)[0] == 3  # the last append added nothing
    df = read_table(spark, t)
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "int"), ("release_id", "string")]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, [
        ("1", None, None, "2013"), ("2", "x", None, "2014"), (None, "y", 3, "2015"), ("4", None, None, "2016")]))
    # a broken data file breaks a footer merge, but not the schema of a read or an append
    with open(f"{scratch}/evolving/release_id=2013/part-broken.snappy.parquet", "wb") as fh:
        fh.write(b"no footer")
    assert read_table(spark, t).columns == ["a", "b", "c", "release_id"]
    append_merging(spark, spark.createDataFrame([("5", "2016")], "a string, release_id string"), t)
    assert read_table(spark, t).where("release_id = '2016'").count() == 2


def test_a_generation_is_stored_by_one_writer(spark, scratch):
    t = Table(f"{scratch}/raced", ())
    create_table(spark.createDataFrame([("1",)], "a string"), t)
    schema = read_table(spark, t).schema
    assert store_schema(spark, t, schema, 1) == 2
    with pytest.raises(RuntimeError, match="another writer"):
        store_schema(spark, t, schema, 1)
    with pytest.raises(ValueError, match="exists"):
        create_table(spark.createDataFrame([("2",)], "a string"), t)


def test_a_creation_that_crashed_before_its_rows_is_taken_up(spark, scratch):
    t = Table(f"{scratch}/crashed", ())
    store_schema(spark, t, spark.createDataFrame([], "a string, lost int").schema, 0)
    assert not table_exists(spark, t)
    create_table(spark.createDataFrame([("1", "x")], "a string, b string"), t)
    assert [tuple(r) for r in read_table(spark, t).collect()] == [("1", None, "x")]


def test_upsert_is_one_exchange_on_the_key(spark):
    old = spark.createDataFrame([("2013", "a", 1), ("2013", "b", 1)], "release_id string, k string, v int").repartition(3)
    new = spark.createDataFrame([("2013", "b", 2), ("2013", "c", 5), ("2013", "c", 7)], "release_id string, k string, v int").repartition(3)
    df = newest_generation(old, new, KEYS, ["v"])
    assert sorted(tuple(r) for r in df.collect()) == [("2013", "a", 1), ("2013", "b", 2), ("2013", "c", 7)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning(release_id") == 1 and "Join" not in plan and "WindowGroupLimit" in plan


def test_upsert_keeps_the_newest_of_a_batch(spark, scratch):
    t = Table(f"{scratch}/ordered", ("release_id", "snapshot_month"))
    rows = [("2013", "2013-01", "a", 1), ("2013", "2013-01", "a", 3), ("2013", "2013-01", "b", 1)]
    upsert(spark, spark.createDataFrame(rows, DDL), t, KEYS, order=["v"])
    assert _rows(read_table(spark, t)) == [("2013", "2013-01", "a", 3), ("2013", "2013-01", "b", 1)]
    upsert(spark, spark.createDataFrame([("2013", "2013-01", "a", 2), ("2013", "2013-01", "a", 0)], DDL), t, KEYS, order=["v"])
    assert _rows(read_table(spark, t)) == [("2013", "2013-01", "a", 2), ("2013", "2013-01", "b", 1)]


def test_upsert_bounds_its_tasks_by_rows(spark, scratch, monkeypatch):
    """A partition of many rows goes to several tasks, whatever its bytes, and columns without a value join at the end."""
    from drivelake.sinks import tables
    monkeypatch.setattr(tables, "TASK_ROWS", 50)
    t = Table(f"{scratch}/wide", ("release_id", "snapshot_month"))
    base = spark.range(400).selectExpr("'R' as release_id", "'2024-01' as snapshot_month", "cast(id as string) as k", "cast(id as int) as v",
                                       "if(id = 7, 'old', null) as kept", "cast(null as int) as none")
    for rows in (base, base.where("v >= 300").selectExpr("release_id", "snapshot_month", "k", "v + 1000 as v")):
        upsert(spark, rows, t, KEYS, cluster_by=("release_id", "snapshot_month"))
        found = read_table(spark, t)
        files = [r["count"] for r in found.groupBy(F.input_file_name().alias("f")).count().collect()]
        assert len(files) >= 3 and max(files) < 250
    assert found.columns == ["k", "v", "kept", "none", "release_id", "snapshot_month"]
    assert found.agg(F.count("*"), F.count("kept"), F.count("none"), F.sum("v")).first()[:] == (400, 1, 0, sum(range(400)) + 100 * 1000)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_newest_rows_of_small_partitions_take_one_exchange(spark):
    """the window by partition, bucket and key runs on the exchange by partition, with one bucket as with several."""
    from drivelake.sinks import tables
    df = spark.range(100).selectExpr("if(id < 1000, 'R', 'S') as release_id", "concat('2024-0', id % 3 + 1) as snapshot_month", "cast(id % 50 as string) as k", "id as v")
    for n in (40, 10 ** 6):
        rows = tables.clustered_by_partition(df, ["release_id", "snapshot_month"], KEYS, {("R", f"2024-0{m}"): n for m in (1, 2, 3)})
        newest = tables.first_per_key(rows, ["release_id", "snapshot_month", "_bucket", "k"], [F.desc("v")])
        assert _exchanges(newest) == 1
        assert newest.count() == df.select("snapshot_month", "k").distinct().count()


@pytest.mark.parametrize("hot_keys", [True, False])
def test_upsert_of_rows_that_repeat_keys(spark, scratch, hot_keys):
    t = Table(f"{scratch}/repeats", ("release_id", "snapshot_month"))
    df = spark.range(300).selectExpr("'R' as release_id", "'2024-01' as snapshot_month", "cast(id % 100 as string) as k", "cast(id as int) as v")
    for add in (0, 1000):
        upsert(spark, df.withColumn("v", F.col("v") + add), t, KEYS, cluster_by=t.partition_by, order=["v"], hot_keys=hot_keys)
        assert _rows(read_table(spark, t)) == sorted(("R", "2024-01", str(i), 200 + i + add) for i in range(100))


def test_silver_finds_a_hot_key_and_keeps_no_rows_cached(spark, scratch, monkeypatch):
    from drivelake.operators.bronze import write_bronze
    from drivelake.plans import backfill
    monkeypatch.setattr(backfill, "TASK_ROWS", 100)
    asked, cached = [], []
    real = backfill.upsert
    monkeypatch.setattr(backfill, "upsert", lambda *a, **kw: (asked.append(kw["hot_keys"]), cached.append(spark._jsc.getPersistentRDDs().size()), real(*a, **kw))[-1])
    held = spark._jsc.getPersistentRDDs().size()
    for name, serial in (("even", "cast(id as string)"), ("hot", "if(id % 3 = 0, 'HOT', cast(id as string))")):
        lake = backfill.Lakehouse(f"{scratch}/{name}")
        rows = spark.range(1200).selectExpr("'2024-01-05' as date", f"{serial} as serial_number", "'M' as model", "'0' as failure", "'f.csv' as source_file",
                                            "'2024' as release_id", "timestamp_seconds(id) as ingested_at", "'r' as processing_run_id")
        write_bronze(spark, rows, lake.bronze)
        assert backfill.run_silver(spark, ["2024"], lake, "r")["rows"] == 1200
        silver = read_table(spark, lake.silver)
        assert silver.count() == silver.select("drive_serial_number").distinct().count() == (1200 if name == "even" else 801)
    assert asked == [False, True] and cached == [held, held]
    assert silver.where("drive_serial_number = 'HOT'").first()["bronze_ingested_at"] == spark.sql("select timestamp_seconds(1197)").first()[0]


def test_a_spread_table_has_tasks_by_its_rows(spark, scratch, monkeypatch):
    from drivelake.sources import tables as sources
    monkeypatch.setattr(sources, "SPREAD_ROWS", 50)
    spark.range(1000).write.parquet(f"{scratch}/t")
    df = sources.spread_stored(spark.read.parquet(f"{scratch}/t"), "id")
    assert df.rdd.getNumPartitions() == 20 and df.distinct().count() == 1000
