"""Yearly, monthly and weekly activity over the fact and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.functions.expressions import cents, money

# Weeks start on Monday and are named by their first day: a year plus a week number
# would put 2021-01-03 into week 53 of 2021.
GRAINS = {
    "year": ["year"],
    "month": ["year", "month_number"],
    "week": ["week_start"],
}


def daily_activity(fact: DataFrame) -> DataFrame:
    """Row count, billed rows and revenue per day, and of rows without a day.

    Money is summed as whole cents, so the total does not depend on the order of rows. The
    stored amount has 32 bits: cents are exact below 131,072, larger ones are rounded there.
    """
    return fact.groupBy("date_id").agg(
        F.count("*").alias("n_appointments"),
        F.count("amount").alias("n_billed"),
        F.sum(cents("amount")).alias("cents"))


def trend(fact: DataFrame, calendar: DataFrame, grain: str) -> DataFrame:
    """Activity per ``year``, ``month`` or ``week``.

    The fact is reduced to days before it meets the calendar, so the join is between two
    tables of calendar size whatever the size of the fact. Rows without a date, or with one
    outside the calendar, count in a bucket of their own, whose keys are null.
    """
    keys = GRAINS[grain]
    days = daily_activity(fact).join(
        calendar.select("date_id", "year", "month_number",
                        F.date_trunc("week", "full_date").cast("date").alias("week_start")),
        "date_id", "left")
    return days.groupBy(*keys).agg(
        F.sum("n_appointments").alias("n_appointments"),
        F.sum("n_billed").alias("n_billed"),
        money(F.sum("cents")).alias("revenue"))
