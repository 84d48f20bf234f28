"""File-at-a-time streaming equals the batch backfill; replays converge."""
import os

import pytest

from drivelake.plans.backfill import Lakehouse, run_release
from drivelake.sources.tables import read_table
from drivelake.streaming import incremental
from drivelake.streaming.incremental import run_incremental, run_log_table
from drivelake.operators.registry import status_rollup

HEADER = "date,serial_number,model,capacity_bytes,failure\n"


def _day(folder, day, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{day}.csv", "w") as fh:
        fh.write(HEADER + "".join(f"{day},{s},{m},100,{f}\n" for s, m, f in rows))


def _gold(spark, lake):
    return sorted(tuple(r) for r in read_table(spark, lake.gold_model)
                  .select("release_id", "drive_model", "total_drive_days", "drive_failures").collect())


def test_stream_equals_batch_and_late_file(spark, scratch):
    land = f"{scratch}/landing"
    files = {"2024-01-03": [("A", "M1", 0), ("B", "M2", 1)], "2024-01-01": [("A", "M1", 0), ("", "M1", 0)],
             "2024-01-02": [("A", "M1", 1), ("C", "M2", 0)]}
    for day, rows in files.items():
        _day(f"{land}/2024_Q1", day, rows)
    lake = Lakehouse(f"{scratch}/stream_lake")
    q = run_incremental(spark, land, lake, f"{scratch}/ckpt")
    q.awaitTermination(300)
    assert q.exception() is None
    batch_lake = Lakehouse(f"{scratch}/batch_lake")
    run_release(spark, f"{land}/2024_Q1", "2024_Q1", batch_lake)
    assert _gold(spark, lake) == _gold(spark, batch_lake) == [
        ("2024_Q1", "M1", 3, 1), ("2024_Q1", "M2", 2, 1)]
    st = {r["source_file"].rsplit("/", 1)[-1]: r["status"]
          for r in status_rollup(read_table(spark, run_log_table(lake))).collect()}
    assert st == {"2024-01-01.csv": "SUCCESS", "2024-01-02.csv": "SUCCESS", "2024-01-03.csv": "SUCCESS"}
    # a late file for the old release recomputes that release's Gold
    _day(f"{land}/2024_Q1", "2024-01-04", [("D", "M2", 1)])
    q = run_incremental(spark, land, lake, f"{scratch}/ckpt")
    q.awaitTermination(300)
    assert ("2024_Q1", "M2", 3, 2) in _gold(spark, lake)
    silver_rows = read_table(spark, lake.silver).count()
    # replay of everything (new checkpoint = at-least-once redelivery) converges
    q = run_incremental(spark, land, lake, f"{scratch}/ckpt2", max_files=2)
    q.awaitTermination(300)
    assert read_table(spark, lake.silver).count() == silver_rows
    assert read_table(spark, lake.bronze).count() == 7   # 2 + 2 + 2 + 1 rows, none doubled
    assert ("2024_Q1", "M2", 3, 2) in _gold(spark, lake)


def test_multi_release_backfill_equals_per_release(spark, scratch):
    from drivelake.plans.backfill import run_backfill
    land = f"{scratch}/raw"
    _day(f"{land}/2023", "2023-12-30", [("A", "M1", 0), ("B", "M2", 1)])
    _day(f"{land}/2024_Q1", "2024-01-01", [("A", "M1", 1), ("A", "M1", 1), ("C", "", 0)])
    _day(f"{land}/2024_Q1", "2024-01-02", [("A", "M1", 0)])
    one = Lakehouse(f"{scratch}/one")
    verdicts = run_backfill(spark, land, one)
    assert verdicts == {"2023": "PASS", "2024_Q1": "PASS"}
    each = Lakehouse(f"{scratch}/each")
    for rel in ("2023", "2024_Q1"):
        run_release(spark, f"{land}/{rel}", rel, each)
    assert _gold(spark, one) == _gold(spark, each) == [
        ("2023", "M1", 1, 0), ("2023", "M2", 1, 1), ("2024_Q1", "M1", 2, 1)]
    dq = lambda lake: sorted((r["release_id"], r["check_name"], r["result"], r["details"])
                             for r in read_table(spark, lake.dq).collect())
    assert dq(one) == dq(each) and len(dq(one)) == 28
    assert read_table(spark, one.quarantine).count() == 1


def test_missing_required_column_quarantines_scope_and_fails(spark, scratch):
    import pytest
    from drivelake.plans.backfill import run_bronze, run_silver
    land = f"{scratch}/raw/2024_Q1"
    os.makedirs(land, exist_ok=True)
    with open(f"{land}/2024-01-05.csv", "w") as fh:   # no 'model' column at all
        fh.write("date,serial_number,failure\n2024-01-05,A,0\n2024-01-05,B,1\n")
    lake = Lakehouse(f"{scratch}/lake")
    run_bronze(spark, f"{scratch}/raw", "2024_Q1", lake, "run")
    with pytest.raises(ValueError, match="missing"):
        run_silver(spark, "2024_Q1", lake, "run")
    q = read_table(spark, lake.quarantine).collect()
    assert len(q) == 2 and {r["rejection_reason"] for r in q} == {"missing_required_source_column:drive_model"}


@pytest.mark.parametrize("stage", ["BRONZE", "SILVER", "DQ", "GOLD"])
def test_a_failed_file_is_resumed_at_its_stage(spark, scratch, monkeypatch, stage):
    """After the failure and the resume, the tables are those of a run without a failure."""
    land = f"{scratch}/land"
    _day(f"{land}/2024_Q1", "2024-01-01", [("A", "M1", 0), ("", "M1", 0), ("B", "M2", 1)])
    file = f"file:{land}/2024_Q1/2024-01-01.csv"
    lake, calm = Lakehouse(f"{scratch}/lake"), Lakehouse(f"{scratch}/calm")
    calls = []

    def counted(name, job, fail):
        def run(*args, **kw):
            calls.append(name)
            if fail:
                raise RuntimeError(f"lost at {name}")
            return job(*args, **kw)
        return run

    jobs = {"BRONZE": "run_bronze", "SILVER": "run_silver", "DQ": "run_dq", "GOLD": "run_gold"}
    real = {name: getattr(incremental, job) for name, job in jobs.items()}
    for name, job in jobs.items():
        monkeypatch.setattr(incremental, job, counted(name, real[name], name == stage))
    with pytest.raises(RuntimeError, match="lost"):
        incremental.process_files(spark, [file], lake, "2024_Q1", land)
    for name, job in jobs.items():
        monkeypatch.setattr(incremental, job, counted(name, real[name], False))
    calls.clear()
    assert incremental.resume_failed(spark, lake, land) == [file]
    assert calls == list(jobs)[list(jobs).index(stage):]  # nothing before it ran again
    assert incremental.resume_failed(spark, lake, land) == []
    incremental.process_files(spark, [file], calm, "2024_Q1", land)
    assert _gold(spark, lake) == _gold(spark, calm) == [("2024_Q1", "M1", 1, 0), ("2024_Q1", "M2", 1, 1)]
    for table in ("bronze", "silver", "quarantine", "dq", "gold_release"):
        assert read_table(spark, getattr(lake, table)).count() == read_table(spark, getattr(calm, table)).count()
    state = status_rollup(read_table(spark, run_log_table(lake))).collect()[0]
    assert (state["status"], state["failure_count"], state["resume_count"], state["last_failed_stage"]) == (
        "SUCCESS", 1, 0 if stage == "BRONZE" else 1, stage)


def test_the_file_that_fails_is_named_and_those_before_it_are_published(spark, scratch):
    land = f"{scratch}/land"
    _day(f"{land}/2024_Q1", "2024-01-01", [("A", "M1", 0)])
    _day(f"{land}/2024_Q1", "2024-01-03", [("A", "M1", 1)])
    with open(f"{land}/2024_Q1/2024-01-02.csv", "w") as fh:
        fh.write("2024-01-02,A,M1,100,0\n")  # no header
    lake = Lakehouse(f"{scratch}/lake")
    q = run_incremental(spark, land, lake, f"{scratch}/ckpt", max_files=10)
    with pytest.raises(Exception, match="without a header"):
        q.awaitTermination(300)
    assert _gold(spark, lake) == [("2024_Q1", "M1", 1, 0)]
    st = {r["source_file"].rsplit("/", 1)[-1]: r["status"]
          for r in status_rollup(read_table(spark, run_log_table(lake))).collect()}
    assert st["2024-01-01.csv"] == "SUCCESS" and st["2024-01-02.csv"] == "FAILED" and st["2024-01-03.csv"] == "PENDING"


def test_a_file_outside_the_landing_folder_is_refused(spark, scratch):
    _day(f"{scratch}/elsewhere/2024_Q1", "2024-01-01", [("A", "M1", 0)])
    lake = Lakehouse(f"{scratch}/lake")
    with pytest.raises(ValueError, match="must start with"):
        incremental.process_files(spark, [f"file://{scratch}/elsewhere/2024_Q1/2024-01-01.csv"], lake, "2024_Q1", f"{scratch}/land")
