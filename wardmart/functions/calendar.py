"""Calendar attributes of a date, and the calendar dimension in two layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.functions.expressions import date_key

DEFAULT_START, DEFAULT_END = dt.date(2020, 1, 1), dt.date(2026, 12, 31)


def is_weekend(d: Column) -> Column:
    return F.when(F.weekday(d).isin(5, 6), F.lit(True)).otherwise(F.lit(False))


def _full(d: Column) -> dict[str, Column]:
    return {
        "date_id": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_week": F.weekday(d) + 1,
        "day_name": F.date_format(d, "EEEE"),
        "day_of_month": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": is_weekend(d),
    }


def _compact(d: Column) -> dict[str, Column]:
    return {
        "date_key": d,
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": is_weekend(d),
    }


_LAYOUTS = {"full": _full, "compact": _compact}


def calendar_for(bounds: DataFrame, start: str, end: str, layout: str = "full") -> DataFrame:
    """One row per day between two date columns of a one-row DataFrame, both inclusive."""
    days = bounds.select(F.explode(F.sequence(
        F.col(start).cast("date"), F.col(end).cast("date"),
        F.expr("interval 1 day"))).alias("d"))
    columns = _LAYOUTS[layout](F.col("d"))
    return days.select(*[c.alias(name) for name, c in columns.items()])


def calendar(spark: SparkSession, start: dt.date | str = DEFAULT_START,
             end: dt.date | str = DEFAULT_END, layout: str = "full") -> DataFrame:
    """Calendar over a fixed range; ``full`` has eleven columns, ``compact`` six."""
    bounds = spark.range(1).select(
        F.lit(str(start)).alias("start"), F.lit(str(end)).alias("end"))
    return calendar_for(bounds, "start", "end", layout)
