"""D1-D11, A1, E8."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from drivelake.operators import quality as Q
from drivelake.plans.backfill import DQ_SCHEMA
from drivelake.schema import drivestats_fields
from drivelake.sources.tables import Table

FIELDS = drivestats_fields()


def _silver(spark, rows):
    from drivelake.plans.backfill import silver_schema
    schema = silver_schema(FIELDS)
    base = {f.name: None for f in schema.fields}
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[f.name] for f in schema.fields))
    return spark.createDataFrame(data, schema)


def _clean(n=3):
    return [dict(release_id="R", snapshot_date=dt.date(2024, 1, i + 1), drive_serial_number=f"S{i}",
                 drive_model="M", failure_flag=0) for i in range(n)]


def test_clean_scope_14_rows_pass(spark):
    s = _silver(spark, _clean())
    res = Q.evaluate(s, s, FIELDS, "run", "R")
    rows = res.orderBy("check_order").collect()
    assert len(rows) == 14
    assert [r["check_name"] for r in rows][:2] == ["row_count", 'GLUE_DQ::ColumnExists "drive_serial_number"']
    assert {r["result"] for r in rows} == {"PASS"}
    assert Q.verdict(res).collect()[0][0] == "PASS"
    nr = [r for r in rows if r["check_name"] == "null_rate::drive_model"][0]
    assert nr["details"] == "null_count=0; total_rows=3; null_rate=0.000000"


def test_empty_scope_6_rows_fail(spark):
    s = _silver(spark, _clean()).filter(F.lit(False))
    res = Q.evaluate(s, s, FIELDS, "run", "R")
    rows = res.collect()
    assert len(rows) == 6
    assert Q.verdict(res).collect()[0][0] == "FAIL"
    assert {r["check_name"]: r["result"] for r in rows}["null_rate::snapshot_date"] == "FAIL"


def test_null_key_duplicates_extra_column_wrong_type_and_silver_gt_bronze(spark):
    rows = _clean() + [dict(release_id="R", snapshot_date=None, drive_serial_number="S0", drive_model="M",
                            failure_flag=0)]
    s = _silver(spark, rows)
    s2 = s.withColumn("extra", F.lit(1)).withColumn("failure_flag", F.col("failure_flag").cast("bigint"))
    bronze = s.limit(2)
    res = {r["check_name"]: r for r in Q.evaluate(s2, bronze, FIELDS, "run", "R").collect()}
    assert res["business_key_uniqueness"]["result"] == "FAIL"   # NULL tuples are not distinct keys (Q7)
    assert res["business_key_uniqueness"]["details"].endswith("duplicate_rows=1")
    assert res["schema_compatibility"]["details"] == (
        "missing_canonical=[]; unexpected_columns=['extra']; "
        "type_mismatches=['failure_flag: expected=int, actual=bigint']")
    assert res["bronze_silver_row_reconciliation"]["result"] == "FAIL"
    assert res['GLUE_DQ::Completeness "snapshot_date" = 1']["result"] == "FAIL"


def test_persist_then_fail(spark, scratch):
    s = _silver(spark, _clean()).filter(F.lit(False))
    t = Table(f"{scratch}/dq", ("release_id",), DQ_SCHEMA)
    with pytest.raises(Q.DataQualityError):
        Q.persist_then_fail(spark, Q.evaluate(s, s, FIELDS, "run", "R"), t)
    from drivelake.sources.tables import read_table
    assert read_table(spark, t).count() == 6   # written before failing


def test_rule_parser():
    r = Q.parse_rule('Completeness "x" >= 0.95')
    assert (r.kind, r.column, r.op, r.threshold) == ("Completeness", "x", ">=", 0.95)
    with pytest.raises(ValueError):
        Q.parse_rule("Bogus 1")


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["PASS", "WARNING", "FAIL"]), min_size=1, max_size=8),
       st.sampled_from(["PASS", "WARNING", "FAIL"]))
def test_verdict_is_monotone(spark, results, extra):
    """Adding a check never improves the overall verdict."""
    rank = {"PASS": 0, "WARNING": 1, "FAIL": 2}
    df = spark.createDataFrame([(r,) for r in results], "result string")
    before = Q.verdict(df).collect()[0][0]
    after = Q.verdict(df.union(spark.createDataFrame([(extra,)], "result string"))).collect()[0][0]
    assert rank[after] >= rank[before]
    assert before == max(results, key=rank.get)


def test_schema_relation_says_what_the_metadata_check_says(spark):
    """The row of the relations equals that of ``evaluate`` on the same frame."""
    s = _silver(spark, _clean())
    drifted = s.drop("capacity_bytes", "smart_1_raw").withColumn("failure_flag", F.col("failure_flag").cast("bigint")).withColumn("extra", F.lit(1)).withColumn("b", F.lit(1))
    for df in (s, drifted):
        want = [tuple(r) for r in Q.evaluate(df, None, FIELDS, "run", "R").where("check_name = 'schema_compatibility'").select("check_name", "result", "details").collect()]
        assert [tuple(r) for r in Q.schema_compatibility(Q.canonical_relation(spark, FIELDS), Q.column_relation(df)).collect()] == want
    found = Q.schema_findings(Q.canonical_relation(spark, FIELDS), Q.column_relation(drifted)).select("finding", "column_name").collect()
    assert sorted(map(tuple, found)) == [("mismatch", "failure_flag"), ("missing", "capacity_bytes"), ("missing", "smart_1_raw"), ("unexpected", "b"), ("unexpected", "extra")]


def test_metrics_of_the_write_give_the_rows_of_a_scan(spark, scratch):
    """DQ of a release and of one of its files, from what the Silver job measured and from a scan of the tables."""
    import os

    from drivelake.plans.backfill import Lakehouse, run_bronze, run_dq, run_silver
    from drivelake.sources.tables import read_table
    head = "date,serial_number,model,capacity_bytes,failure\n"
    os.makedirs(f"{scratch}/raw/2024_Q1")
    for d, rows in (("01-30", ["S1,M1,1,0", "S2,M1,1,0", ",M1,1,0"]), ("02-01", ["S1,M2,x,1", "S1,M2,1,1", "S3,,1,0"])):
        with open(f"{scratch}/raw/2024_Q1/2024-{d}.csv", "w") as fh:
            fh.write(head + "".join(f"2024-{d},{r}\n" for r in rows))
    lake = Lakehouse(f"{scratch}/lake")
    run_bronze(spark, f"{scratch}/raw", "2024_Q1", lake, "run")
    file = f"file:{scratch}/raw/2024_Q1/2024-02-01.csv"
    for scoped in (None, file, [file], None):
        run = f"run-{scoped is None}-{isinstance(scoped, list)}"
        measured = run_silver(spark, "2024_Q1", lake, run, source_file=scoped)["measured"]
        assert measured["total_rows"] == (3 if scoped is None else 1) and measured["bronze_rows"] == (6 if scoped is None else 3)
        for name, m in (("m", measured), ("s", None)):
            run_dq(spark, "2024_Q1", lake, f"{run}-{name}", source_file=scoped, measured=m)
        rows = read_table(spark, lake.dq).select("run_id", "check_name", "result", "details").collect()
        of = lambda name: sorted({tuple(r)[1:] for r in rows if r.run_id == f"{run}-{name}"})  # noqa: B023, E731
        assert of("m") == of("s") and len(of("m")) == 14
    silver = read_table(spark, lake.silver)
    plan = Q.evaluate(silver, silver, FIELDS, "run", "2024_Q1", measured=measured)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
