"""Rows whose key the target does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key; of several rows the smallest, so that a rerun picks the same."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.dropDuplicates()
    picked = df.groupBy(key).agg(F.min(F.struct(*others)).alias("row"))
    return picked.select(key, "row.*").select(*df.columns)


def absent_rows(new: DataFrame, target: DataFrame | None, key: str,
                unique: bool = False) -> DataFrame:
    """Rows of ``new`` to append to ``target``; only the target's key column is read.

    ``unique=True`` skips the per-key pick when the key is known to be unique. The
    target's keys are made distinct before their shuffle, which the join then reuses, so
    a key that the target repeats very often does not gather in one task.
    """
    rows = new if unique else one_per_key(new, key)
    if target is None:
        return rows
    return rows.join(target.select(key).distinct(), key, "left_anti").select(*new.columns)
