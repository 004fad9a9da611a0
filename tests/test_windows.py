from datetime import date

import pytest
from pyspark.sql import functions as F

from loanlens.functions.windows import (
    ReportingWindow,
    add_months,
    previous_month,
    reporting_month,
    reporting_window,
    rolling_month,
    rolling_month_shifted,
    window_columns,
)


def W(a, b):
    return ReportingWindow(date.fromisoformat(a), date.fromisoformat(b))


@pytest.mark.parametrize(
    "as_of, a, b, c",
    [
        ("2018-07-01", W("2018-06-01", "2018-06-30"), W("2018-06-01", "2018-06-30"), W("2018-05-30", "2018-06-30")),
        ("2018-07-15", W("2018-06-01", "2018-06-30"), W("2018-06-15", "2018-07-14"), W("2018-06-14", "2018-07-14")),
        ("2018-03-31", W("2018-02-01", "2018-02-28"), W("2018-02-28", "2018-03-30"), W("2018-02-28", "2018-03-30")),
        ("2018-03-01", W("2018-02-01", "2018-02-28"), W("2018-02-01", "2018-02-28"), W("2018-01-28", "2018-02-28")),
        ("2020-03-31", W("2020-02-01", "2020-02-29"), W("2020-02-29", "2020-03-30"), W("2020-02-29", "2020-03-30")),
        ("2018-01-01", W("2017-12-01", "2017-12-31"), W("2017-12-01", "2017-12-31"), W("2017-11-30", "2017-12-31")),
    ],
)
def test_worked_windows(as_of, a, b, c):
    d = date.fromisoformat(as_of)
    assert previous_month(d) == a
    assert rolling_month(d) == b
    assert rolling_month_shifted(d) == c
    assert reporting_window(d, "C") == c


def test_add_months_clamps_day():
    assert add_months(date(2018, 3, 31), -1) == date(2018, 2, 28)
    assert add_months(date(2018, 2, 28), -1) == date(2018, 1, 28)
    assert add_months(date(2018, 1, 31), 1) == date(2018, 2, 28)
    assert add_months(date(2018, 1, 15), -13) == date(2016, 12, 15)


def test_reporting_month_is_run_month():
    assert reporting_month(date(2018, 7, 15)) == "2018-07-01"


def test_empty_window_rejected():
    with pytest.raises(ValueError):
        W("2018-06-02", "2018-06-01")


def test_column_windows_equal_driver_windows(spark):
    days = [date(2018, 7, 1), date(2018, 7, 15), date(2018, 3, 31), date(2018, 3, 1),
            date(2020, 3, 31), date(2018, 1, 1), date(2019, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "as_of date")
    cols = []
    for kind in "ABC":
        s, e = window_columns(F.col("as_of"), kind)
        cols += [s.alias(kind + "s"), e.alias(kind + "e")]
    for r in df.select("as_of", *cols).collect():
        for kind in "ABC":
            assert reporting_window(r.as_of, kind) == ReportingWindow(r[kind + "s"], r[kind + "e"])


def test_driver_windows_equal_spark_on_random_dates(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    seen: list[date] = []

    @settings(max_examples=300, deadline=None)
    @given(st.dates(min_value=date(1990, 1, 1), max_value=date(2040, 12, 31)))
    def collect(d):
        seen.append(d)

    collect()
    df = spark.createDataFrame([(d,) for d in seen], "as_of date")
    cols = []
    for kind in "ABC":
        s, e = window_columns(F.col("as_of"), kind)
        cols += [s.alias(kind + "s"), e.alias(kind + "e")]
    from loanlens.functions.windows import reporting_month_column

    for r in df.select("as_of", reporting_month_column(F.col("as_of")).alias("m"), *cols).collect():
        assert reporting_month(r.as_of) == r.m
        for kind in "ABC":
            assert reporting_window(r.as_of, kind) == ReportingWindow(r[kind + "s"], r[kind + "e"]), (r.as_of, kind)
