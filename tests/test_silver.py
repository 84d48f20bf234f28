"""Canonical projection and row validation."""
import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from drivelake.operators import silver as S
from drivelake.schema import drivestats_fields, load_fields

FIELDS = drivestats_fields()
RAW = "date string, serial_number string, model string, failure string, capacity_bytes string, " \
      "release_id string, source_file string, ingested_at timestamp"


def _bronze(spark, rows):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([r + ("R1", "f.csv", t) for r in rows], RAW)


def test_schema_has_85_fields_4_required():
    assert len(FIELDS) == 85
    assert [f.name for f in FIELDS if not f.nullable] == [
        "snapshot_date", "drive_serial_number", "drive_model", "failure_flag"]


def test_yaml_loader_roundtrip():
    text = """columns:
  - {name: a, source_column: x, datatype: integer, nullable: false}
  - {name: b, datatype: long}
"""
    fs = load_fields(text)
    assert [(f.name, f.source_column, f.type_name, f.nullable) for f in fs] == [
        ("a", "x", "int", False), ("b", "b", "bigint", True)]


def test_reasons_none_one_all(spark):
    rows = [("2013-04-10", "S1", "M", "0", "1"),       # valid
            ("2013-04-10", "S2", "M", "abc", "1"),     # bad flag
            ("", "   ", None, "", None),               # all four bad; serial of spaces
            ("2013-4-10", "S3", " ", "1", "x")]        # bad date, blank model
    cand = S.candidate(_bronze(spark, rows), FIELDS)
    got = {r["drive_serial_number"]: r["_rejection_reason"] for r in cand.collect()}
    assert got["S1"] is None
    assert got["S2"] == "invalid_required_field:failure_flag"
    assert got[None] == ("invalid_required_field:snapshot_date;invalid_required_field:drive_serial_number;"
                         "invalid_required_field:drive_model;invalid_required_field:failure_flag")
    assert got["S3"] == "invalid_required_field:snapshot_date;invalid_required_field:drive_model"


def test_missing_nullable_source_is_typed_null(spark):
    cand = S.candidate(_bronze(spark, [("2013-04-10", "S1", "M", "0", "1")]), FIELDS)
    types = dict(cand.dtypes)
    assert types["smart_5_raw"] == "bigint" and types["smart_5_normalized"] == "int"
    r = cand.collect()[0]
    assert r["smart_5_raw"] is None and r["capacity_bytes"] == 1 and r["snapshot_date"] == dt.date(2013, 4, 10)


def test_missing_required_source_goes_to_schema_quarantine(spark):
    b = _bronze(spark, [("2013-04-10", "S1", "M", "0", "1")]).drop("model")
    missing = S.missing_required(FIELDS, b.columns)
    assert missing == ["drive_model"]
    with pytest.raises(ValueError):
        S.candidate(b, FIELDS)
    q = S.quarantine_schema(b, missing, "run")
    assert q.collect()[0]["rejection_reason"] == "missing_required_source_column:drive_model"


def test_case_insensitive_source_columns(spark):
    b = _bronze(spark, [("2013-04-10", "S1", "M", "0", "1")]).withColumnRenamed("model", "Model")
    assert S.candidate(b, FIELDS).collect()[0]["drive_model"] == "M"


def test_flag_two_and_blank_serial_pass_silver(spark):
    # P6 cases: failure_flag 2 passes Silver (checked only in Gold, Q10)
    cand = S.candidate(_bronze(spark, [("2013-04-10", "S1", "M", "2", None)]), FIELDS)
    r = cand.collect()[0]
    assert r["_rejection_reason"] is None and r["failure_flag"] == 2


text = st.one_of(st.none(), st.sampled_from(["", " ", "1", "0", "5.9", "abc", "2013-04-10", "2013-4-1", "S", " M "]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(text, text, text, text, text), min_size=0, max_size=12))
def test_accepted_plus_rejected_is_input(spark, rows):
    cand = S.candidate(_bronze(spark, rows), FIELDS)
    acc, rej = S.split_valid(cand)
    assert acc.count() + rej.count() == len(rows)
