"""Scalar helpers on hand-made edge rows."""
import datetime as dt

from pyspark.sql import functions as F

from drivelake.functions.casts import blank_to_null, lenient_cast, strict_date
from drivelake.functions.metrics import afr, days_in_year, null_rate


def _col(spark, values, expr, ddl="s string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_lenient_int_cast_matches_legacy_cast(spark):
    cases = ["5", " 5 ", "5.0", "5.9", "-7.99", ".5", "5.", "+3", "abc", "", "99999999999",
             "99999999999.5", "1e3", None]
    want = [5, 5, 5, 5, -7, 0, 5, 3, None, None, None, None, None, None]
    assert _col(spark, cases, lenient_cast("s", "int")) == want


def test_lenient_bigint_and_string(spark):
    assert _col(spark, ["99999999999", "-0", "1.5"], lenient_cast("s", "bigint")) == [99999999999, 0, 1]
    assert _col(spark, ["x"], lenient_cast("s", "string")) == ["x"]
    assert _col(spark, ["1.5", "x"], lenient_cast("s", "double")) == [1.5, None]


def test_strict_date(spark):
    cases = ["2013-04-10", "2013-4-1", " 2013-04-10", "2013-04-10 ", "20130410", "2013-02-30",
             "2013-04-10T00:00", "", None]
    got = _col(spark, cases, strict_date("s"))
    assert got == [dt.date(2013, 4, 10)] + [None] * 8


def test_blank_to_null(spark):
    assert _col(spark, ["  a ", "   ", "", None, "b"], blank_to_null("s")) == ["a", None, None, None, "b"]


def test_days_in_year_gregorian(spark):
    df = spark.createDataFrame([(dt.date(y, 6, 1),) for y in (1900, 2000, 2023, 2024)], "d date")
    assert [r[0] for r in df.select(days_in_year("d")).collect()] == [365, 366, 365, 366]


def test_afr_and_null_rate(spark):
    df = spark.createDataFrame([(2, 730, 365), (0, 0, 365)], "f long, d long, y int")
    got = [r[0] for r in df.select(afr("f", "d", "y")).collect()]
    assert got == [2 / (730 / 365.0) * 100.0, None]
    df = spark.createDataFrame([(0, 0), (1, 4)], "n long, t long")
    assert [r[0] for r in df.select(null_rate("n", "t")).collect()] == [1.0, 0.25]


import re  # noqa: E402

from hypothesis import given, settings, strategies as st  # noqa: E402

from drivelake.functions.casts import DATE_TEXT, INTEGER_PART, NUMBER_TEXT  # noqa: E402


def _legacy_int(s):
    """The rule the casts implement, written with Python's re (reference for the test)."""
    if s is None:
        return None
    t = s.strip(" ")
    if not re.fullmatch(NUMBER_TEXT[1:-1], t):
        return None
    whole = re.fullmatch(INTEGER_PART[1:-1], t).group(1)
    v = int(whole) if whole not in ("", "+", "-") else 0
    return v if -2**31 <= v < 2**31 else None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. e", max_size=7), min_size=1, max_size=40))
def test_lenient_int_cast_property(spark, values):
    got = _col(spark, values, lenient_cast("s", "int"))
    assert got == [_legacy_int(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-/ ", min_size=8, max_size=11), min_size=1, max_size=30))
def test_strict_date_shape_property(spark, values):
    got = _col(spark, values, strict_date("s"))
    for v, d in zip(values, got):
        if v.startswith("0000"):
            continue  # year 0 exists in Spark's proleptic calendar, not in Python's date
        if not re.fullmatch(DATE_TEXT[1:-1], v):
            assert d is None
        else:
            try:
                want = dt.date(int(v[:4]), int(v[5:7]), int(v[8:]))
            except ValueError:
                want = None
            assert d == want, v
