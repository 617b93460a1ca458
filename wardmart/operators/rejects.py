"""An account of the values that conversions lose.

A conversion turns a value that does not parse into null. Here each such value is kept beside
its row, as column name and raw text, and counted by the write that stores the rows: nothing
is read a second time. The table of rejected values is taken from what was stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Where a row's rejected values are kept: an array of column and raw text, null if there are none.
REJECTED = "_rejected"


def rejected_values(conversions: Mapping[str, tuple[Column, Column]]) -> Column:
    """The array of what ``conversions`` (name -> raw, converted) lose; null if nothing."""
    lost = [
        F.when(raw.isNotNull() & value.isNull(),
               F.struct(F.lit(name).alias("column"), raw.cast("string").alias("raw")))
        for name, (raw, value) in conversions.items()]
    if not lost:
        return F.lit(None).cast("array<struct<column:string,raw:string>>")
    found = F.array_compact(F.array(*lost))
    return F.when(F.size(found) > 0, found)


def convert(df: DataFrame, values: Mapping[str, Column], raw: Mapping[str, Column] | None = None,
            into: str | None = None) -> DataFrame:
    """``df.withColumns(values)``; with ``into``, what they lose is added to that column.

    A conversion's raw value is the column of its name; ``raw`` names others.
    """
    if into is None:
        return df.withColumns(dict(values))
    sources = {name: (raw or {}).get(name, F.col(name) if name in df.columns else F.lit(None)) for name in values}
    lost = rejected_values({name: (sources[name], value) for name, value in values.items()})
    if into in df.columns:
        before, empty = F.col(into), F.array().cast("array<struct<column:string,raw:string>>")
        both = F.concat(F.coalesce(before, empty), F.coalesce(lost, empty))
        lost = F.when(F.size(both) > 0, both)
    return df.withColumns({**values, into: lost})


class RejectedValues(ValueError):
    """More values were rejected than a run allows."""


class Account:
    """Counts of rows and of rejected values by column, taken while the rows are written."""

    def __init__(self, name: str, columns: Sequence[str]):
        self.name, self.columns = name, list(columns)
        self._seen = Observation()

    def watch(self, df: DataFrame, column: str = REJECTED) -> DataFrame:
        """``df`` unchanged; the next action on it fills this account."""
        def of(name: str) -> Column:
            return F.count_if(F.coalesce(F.exists(column, lambda x: x["column"] == name), F.lit(False)))

        counts = [of(name).alias(f"lost_{i}") for i, name in enumerate(self.columns)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    @property
    def rejected(self) -> dict[str, int]:
        """How many values of each column were rejected; to be asked after the action."""
        return {name: self._seen.get[f"lost_{i}"] for i, name in enumerate(self.columns)}

    def require_at_most(self, limit: int | None) -> None:
        """Raise when more than ``limit`` values were rejected; None allows any number."""
        found = {c: n for c, n in self.rejected.items() if n}
        if limit is not None and sum(found.values()) > limit:
            raise RejectedValues(f"{self.name}: {sum(found.values())} rejected values, {limit} allowed: {found}")


def rejects(stored: DataFrame, keys: Sequence[str], column: str = REJECTED) -> DataFrame:
    """One row per rejected value: the row's ``keys`` as stored, the column and the raw text."""
    return (stored.where(F.col(column).isNotNull())
            .select(*keys, F.explode(column).alias("lost"))
            .select(*keys, F.col("lost.column").alias("column"), F.col("lost.raw").alias("raw")))
