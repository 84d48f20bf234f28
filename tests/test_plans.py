"""Plan shapes the scale design relies on, checked with explain()."""
import datetime as dt

import pytest

from __spark_entry__ import queries
from drivelake.plans.backfill import Lakehouse, silver_frames
from drivelake.plans import observations as O
from drivelake.schema import drivestats_fields
from drivelake.sinks.tables import create_table
from drivelake.sources.tables import read_table, scope

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_dedup_keeps_latest_before_the_shuffle(spark):
    silver = silver_frames(O.lineitem_bronze(spark, SF), drivestats_fields(), "r")[0]
    plan = df_plan = _plan(silver)
    assert "WindowGroupLimit" in plan
    # partial top-1 per key sits below (before) the hash exchange on the key
    lines = [ln for ln in df_plan.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning" in ln]
    kinds = ["limit-partial" if "Partial" in ln else "limit-final" if "Final" in ln else "exchange" for ln in lines]
    assert kinds.index("limit-final") < kinds.index("exchange") < kinds.index("limit-partial")


def test_scopes_prune_partitions_and_push_file_filter(spark, scratch):
    lake = Lakehouse(scratch)
    t = lake.bronze
    create_table(spark.createDataFrame([("a", "f1", "1996"), ("b", "f2", "1997")],
                                       "x string, source_file string, release_id string"), t)
    df = scope(read_table(spark, t), "1996", "f1")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(release_id" in plan and "= 1996" in plan
    assert "PushedFilters: [IsNotNull(source_file), EqualTo(source_file,f1)]" in plan
    assert df.count() == 1


def test_gold_reads_only_needed_columns(spark):
    plan = _formatted(queries()["gold_model_metrics"](spark, SF))
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_")]
    # only the columns the observations use; price, tax, discount, supplier stay on disk
    assert schemas == ["ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,"
                       "l_returnflag:string,l_shipdate:timestamp_ntz>"]


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
