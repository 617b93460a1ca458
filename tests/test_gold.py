"""Fact, dimensions and trends on small silver tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from wardmart.functions.calendar import calendar
from wardmart.operators.joins import measured_hot_keys
from wardmart.operators.quality import pk_violations
from wardmart.plans import gold
from wardmart.plans.trends import trend
from wardmart.schemas import conform, gold_tables


@pytest.fixture(scope="module")
def silver(spark):
    at = dt.datetime(2023, 8, 9, 8)
    appointments = spark.createDataFrame(
        [(1, 1, 1, 20230809, at, "a", "r"), (2, 1, 1, 20230809, at, "a", "r"),
         (3, 2, 1, 20240229, at, "a", "r"), (4, 2, None, None, None, "a", "r"),
         (None, 1, 1, 20230809, at, "a", "r")],
        "appointment_id int, patient_id int, doctor_id int, date_id int, "
        "appointment_timestamp timestamp, status string, reason_for_visit string")
    treatments = spark.createDataFrame(
        [(10, 1, "MRI", "d", 5.0), (11, 1, "ECG", "d", 6.0), (12, 2, "MRI", "d", 7.0),
         (13, 3, "MRI", "d", None), (14, None, "MRI", "d", 1.0)],
        "treatment_id int, appointment_id int, treatment_type string, description string, "
        "cost float")
    billing = spark.createDataFrame(
        [(100, 1, 10, 5.25), (101, 1, 10, 1.5), (102, 2, 12, 9.0), (103, 1, None, 2.0),
         (104, 2, 13, None)],
        "bill_id int, patient_id int, treatment_id int, amount float")
    return appointments, treatments, billing


def key(r):
    return tuple((v is None, v) for v in (r.appointment_id, r.treatment_id, r.amount))


EXPECTED = [
    (1, 10, 1.5), (1, 10, 5.25),     # two bills
    (1, 11, None),                   # treatment without bill
    (2, 12, None),                   # right treatment, another patient's bill
    (3, 13, None),                   # bill without amount
    (4, None, None),                 # no treatment; the bill without treatment stays out
    (None, None, None),              # null keys match nothing
]


def test_fact(silver):
    rows = sorted(gold.fact_appointments(*silver).collect(), key=key)
    assert [(r.appointment_id, r.treatment_id, r.amount) for r in rows] == EXPECTED


def test_fact_with_hot_keys(silver):
    _, treatments, billing = silver
    hot_t = measured_hot_keys(treatments, "appointment_id", min_rows=2, rows_per_salt=1)
    hot_b = measured_hot_keys(billing, ["patient_id", "treatment_id"], 2, 1)
    assert hot_t.count() == 1 and hot_b.count() == 1
    rows = sorted(gold.fact_appointments(*silver, hot_t, hot_b).collect(), key=key)
    assert [(r.appointment_id, r.treatment_id, r.amount) for r in rows] == EXPECTED


def test_fact_grain_is_reported(silver):
    found = pk_violations(gold.fact_appointments(*silver), "appointment_id")
    assert {(r.appointment_id, r.n) for r in found.collect()} == {(1, 3), (None, 1)}


def test_fact_fits_its_contract(silver):
    schema = gold_tables()["fact_appointments"].schema
    assert conform(gold.fact_appointments(*silver), schema).schema == schema


def test_conform_refuses_missing_columns(spark):
    with pytest.raises(ValueError, match="cost"):
        conform(spark.createDataFrame([(1, "a", "b")],
                                      "treatment_id int, treatment_type string, "
                                      "description string"),
                gold_tables()["dim_treatments"].schema)


def test_ordered_dimension_starts_with_nulls(silver):
    rows = gold.ordered(gold.dim_treatments(silver[1]), "dim_treatments").collect()
    assert [r.cost for r in rows] == [None, 1.0, 5.0, 6.0, 7.0]


def test_trends(spark, silver):
    fact, days = gold.fact_appointments(*silver), calendar(spark, "2023-01-01", "2024-12-31")
    by_year = {r.year: r for r in trend(fact, days, "year").collect()}
    assert sum(r.n_appointments for r in by_year.values()) == fact.count()
    by_year.pop(None, None)
    assert set(by_year) == {2023, 2024}
    assert (by_year[2023].n_appointments, by_year[2023].n_billed) == (5, 2)
    assert by_year[2023].revenue == Decimal("6.75")
    assert by_year[2024].revenue is None
    months = {(r.year, r.month_number) for r in trend(fact, days, "month").collect()} - {(None, None)}
    assert months == {(2023, 8), (2024, 2)}
    weeks = {r.week_start for r in trend(fact, days, "week").collect()} - {None}
    assert weeks == {dt.date(2023, 8, 7), dt.date(2024, 2, 26)}


def test_week_of_a_new_year_is_one_bucket(spark):
    """2020-12-31 and 2021-01-03 lie in the same Monday week."""
    fact = spark.createDataFrame([(20201231, 1.0), (20210103, 2.0)], "date_id int, amount float")
    rows = trend(fact, calendar(spark, "2020-01-01", "2021-12-31"), "week").collect()
    assert [(r.week_start, r.n_appointments) for r in rows] == [(dt.date(2020, 12, 28), 2)]
