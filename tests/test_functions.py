"""Column expressions, on the edge cases the given tables lack."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardmart.functions import expressions as X
from wardmart.functions.calendar import calendar


def values(spark, column, data, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_standardize_id(spark):
    found = values(spark, X.standardize_id("v", "D"),
                   ["D101", "D007", "D1X", "D1D2", "P5", "", None])
    assert found == [101, 7, None, 12, None, None, None]


def test_standardize_id_leaves_numbers(spark):
    assert values(spark, X.standardize_id("v", "D"), [5, None], "int") == [5, None]


def test_wide_ids_need_the_wide_type(spark):
    assert values(spark, X.standardize_id("v", "A", "int"), ["A3000000000"]) == [None]
    assert values(spark, X.standardize_id("v", "A", "bigint"), ["A3000000000"]) == [3000000000]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**31 - 1), min_size=1, max_size=20))
def test_every_plain_id_survives(spark, numbers):
    texts = [f"P{n:03d}" for n in numbers]
    assert values(spark, X.standardize_id("v", "P"), texts) == numbers


def test_title_clean(spark):
    found = values(spark, X.title_clean("v"), ["  mARY ann-lee ", "x", "", None])
    assert found == ["Mary Ann-lee", "X", "", None]


def test_full_name_leaves_out_missing_parts(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "f string, l string")
    assert [r[0] for r in df.select(X.full_name("f", "l")).collect()] == ["A B", "A", ""]


def test_address_region(spark):
    found = values(spark, X.address_region("v"), ["789 Pine Rd", "abc", "", None])
    assert found == ["Pine", None, None, None]


def test_as_date(spark):
    assert values(spark, X.as_date("v"), ["2024-02-29", "garbage", None]) == [
        dt.date(2024, 2, 29), None, None]


def test_date_key(spark):
    assert values(spark, X.date_key("v"), ["2024-02-29", "0999-01-05", "garbage", None]) == [
        20240229, 9990105, None, None]


@pytest.mark.parametrize("date, time, expected", [
    ("2023-08-09", "8:00:00", dt.datetime(2023, 8, 9, 8)),
    ("2023-08-09", "15:15:00", dt.datetime(2023, 8, 9, 15, 15)),
    ("2023-08-09", "garbage", None),
    ("2023-08-09", None, None),
    (None, "8:00:00", None),
    (None, None, None),
])
def test_event_timestamp(spark, date, time, expected):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    assert df.select(X.event_timestamp("d", "t")).first()[0] == expected


def test_age(spark):
    assert values(spark, X.age_in_years("v", "2024-01-01"), [1991, None], "int") == [33, None]


def test_run_date_is_the_clock_without_a_date(spark):
    row = spark.range(1).select(X.run_date() == F.current_date()).first()
    assert row[0] is True


def test_real_cast(spark):
    assert values(spark, X.as_real("v"), ["1.5", "x", None]) == [1.5, None, None]


def test_cents_and_money(spark):
    found = values(spark, X.cents("v"), [3941.97, 0.125, -0.125, 0.0, float("nan"), None],
                   "float")
    assert found == [394197, 13, -13, 0, None, None]
    assert values(spark, X.money("v"), [394197, -13, None], "bigint") == [
        Decimal("3941.97"), Decimal("-0.13"), None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**13, 10**13), min_size=1, max_size=50))
def test_every_amount_keeps_its_cents(spark, amounts):
    assert values(spark, X.cents("v"), [a / 100 for a in amounts], "double") == amounts


def test_full_calendar(spark):
    df = calendar(spark, "2020-01-01", "2026-12-31")
    assert df.count() == 2557
    assert df.filter("is_weekend").count() == 730
    rows = {r["date_id"]: r for r in df.filter("date_id in (20210103, 20240229)").collect()}
    sunday, leap = rows[20210103], rows[20240229]
    assert sunday["week_of_year"] == 53 and sunday["day_of_week"] == 7
    assert sunday["is_weekend"] and sunday["day_name"] == "Sunday"
    assert leap["month_name"] == "February" and leap["quarter"] == 1
    assert leap["day_of_month"] == 29 and not leap["is_weekend"]
    assert leap["full_date"] == dt.date(2024, 2, 29)


def test_compact_calendar(spark):
    df = calendar(spark, "2024-02-28", "2024-03-02", "compact")
    assert df.columns == ["date_key", "year", "month", "day", "day_name", "is_weekend"]
    assert [tuple(r) for r in df.orderBy("date_key").collect()] == [
        (dt.date(2024, 2, 28), 2024, 2, 28, "Wednesday", False),
        (dt.date(2024, 2, 29), 2024, 2, 29, "Thursday", False),
        (dt.date(2024, 3, 1), 2024, 3, 1, "Friday", False),
        (dt.date(2024, 3, 2), 2024, 3, 2, "Saturday", True)]


def test_large_ids_stay(spark):
    row = spark.createDataFrame([("P3000000000",)], "c string").select(X.standardize_id("c", "P").alias("n"))
    assert row.first().n == 3_000_000_000
