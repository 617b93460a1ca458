"""Types of text columns, found in one pass over stored text.

The types form a ladder from narrow to wide. One aggregate counts for every column and type
how many values do not fit, and keeps the least of them as an example; a column gets the
first type that all its values fit. A column without values is text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The types from narrow to wide and what a value must look like. A value that
# looks right must also lie in the type's range (2024-02-30 is no date).
LADDER = {
    "boolean": r"^(?i)(true|false)$",
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$",
}
WIDEST = "string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _misfit(c: Column, kind: str) -> Column:
    """Whether a value is there and is none of ``kind``."""
    return c.isNotNull() & ~(c.rlike(LADDER[kind]) & c.try_cast(kind).isNotNull())


def type_report(text: DataFrame) -> DataFrame:
    """column, type, n_values, n_misfits, least_misfit (the first by its bytes) and chosen, for
    every text column and type; one scan and one row of partial results a task."""
    names = text.columns
    found = text.agg(*[
        F.struct(
            F.count(F.col(_quoted(name))).alias("n_values"),
            *[F.count_if(_misfit(F.col(_quoted(name)), kind)).alias(f"n_{kind}") for kind in LADDER],
            *[F.min(F.when(_misfit(F.col(_quoted(name)), kind), F.col(_quoted(name)))).alias(f"least_{kind}")
              for kind in LADDER]).alias(f"c{i}")
        for i, name in enumerate(names)])
    rows = []
    for i, name in enumerate(names):
        one = F.col(f"c{i}")
        fits = [(one["n_values"] > 0) & (one[f"n_{kind}"] == 0) for kind in LADDER]
        before = [reduce(Column.__or__, fits[:at], F.lit(False)) for at in range(len(fits) + 1)]
        rows += [
            F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), one["n_values"].alias("n_values"),
                     one[f"n_{kind}"].alias("n_misfits"), one[f"least_{kind}"].alias("least_misfit"),
                     (fits[at] & ~before[at]).alias("chosen"))
            for at, kind in enumerate(LADDER)]
        rows.append(F.struct(
            F.lit(name).alias("column"), F.lit(WIDEST).alias("type"), one["n_values"].alias("n_values"),
            F.lit(0).cast("bigint").alias("n_misfits"), F.lit(None).cast("string").alias("least_misfit"),
            (~before[-1]).alias("chosen")))
    return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def inferred_types(text: DataFrame) -> dict[str, str]:
    """The type of every column: as many rows reach the driver as there are columns."""
    if not text.columns:
        return {}
    found = {r["column"]: r["type"] for r in type_report(text).where("chosen").collect()}
    return {name: found[name] for name in text.columns}


def typed(text: DataFrame, types: dict[str, str]) -> DataFrame:
    return text.select(*[F.col(_quoted(name)).try_cast(types[name]).alias(name) for name in text.columns])
