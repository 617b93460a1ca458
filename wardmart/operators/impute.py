"""Null filling and row cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def deduplicate(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies within a partition are merged before the shuffle."""
    return df.dropDuplicates()


def drop_empty(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the rows in which every key column is null."""
    return df.dropna("all", subset=list(keys))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def _is_missing_aware(df: DataFrame, column: str) -> Column:
    """The column with NaN counted as missing, as ``fillna`` does for floating types."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(c, F.lit(None))
    return c


def fill(df: DataFrame, replacements: Mapping[str, Column]) -> DataFrame:
    """Replace nulls of each named column by an expression, in one projection."""
    return df.withColumns({
        name: F.coalesce(_is_missing_aware(df, name), value)
        for name, value in replacements.items()
    })


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``fillna`` that refuses a word for a column that is not text.

    Spark itself skips or fails on such a pair, depending on the session.
    """
    for name, value in values.items():
        kind = df.schema[name].dataType
        if isinstance(value, str) != isinstance(kind, T.StringType):
            raise TypeError(
                f"cannot fill {name} ({kind.simpleString()}) with {value!r}")
    return df.fillna(dict(values))
