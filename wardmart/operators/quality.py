"""Integrity rules as queries that return what breaks them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pk_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once or hold a null, with their row counts ``n``."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (
        df.groupBy(*key).agg(F.count("*").alias("n"))
        .filter((F.col("n") > 1) | has_null)
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def fk_orphans(fact: DataFrame,
               references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Foreign key values without a dimension row: ``fk``, ``key_value``, ``n_rows``.

    A null foreign key is allowed. All foreign keys are counted in one pass over the
    fact, and only distinct values of both sides take part in the anti join, so a value
    that fills a third of the fact is one row there. The join needs no further shuffle.
    Keys must have the type of the dimension's, or both be whole numbers; ``key_value`` is
    a bigint if all keys are whole numbers, else text.
    """
    kinds = {}
    for n, (dim, key) in references.items():
        kinds[n], other = fact.schema[n].dataType, dim.schema[key].dataType
        whole = isinstance(kinds[n], T.IntegralType) and isinstance(other, T.IntegralType)
        if kinds[n] != other and not whole:
            raise TypeError(f"{n} is {kinds[n].simpleString()}, {key} is {other.simpleString()}")
    kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds.values()) else "string"
    counted = F.count("*").alias("n_rows")
    if len(references) == 1:
        # One key is compared by itself: a constant beside it would cost another shuffle.
        (n, (dim, key)), = references.items()
        used = fact.select(F.col(n).cast(kind).alias("key_value")).dropna().groupBy("key_value").agg(counted)
        known = dim.select(F.col(key).cast(kind).alias("key_value")).distinct()
        return used.join(known, "key_value", "left_anti").select(F.lit(n).alias("fk"), "key_value", "n_rows")
    keys = fact.select(*[F.col(n).cast(kind).alias(n) for n in references])
    used = (
        keys.unpivot([], list(references), "fk", "key_value")
        .filter(F.col("key_value").isNotNull())
        .groupBy("fk", "key_value").agg(counted)
    )
    known = reduce(DataFrame.unionAll, [
        dim.select(F.lit(n).alias("fk"), F.col(key).cast(kind).alias("key_value"))
        for n, (dim, key) in references.items()]).distinct()
    return used.join(known, ["fk", "key_value"], "left_anti")


class IntegrityError(ValueError):
    """A table breaks a rule; the message lists some of the offending keys."""


def require_none(violations: DataFrame, rule: str, examples: int = 10) -> None:
    """Raise when ``violations`` has rows. Only a few examples reach the driver."""
    found = violations.take(examples)
    if found:
        shown = ", ".join(str(r.asDict()) for r in found)
        raise IntegrityError(f"{rule}: {shown}")


def require_no_nulls(df: DataFrame, columns: Sequence[str], rule: str) -> None:
    broken = {c: n for c, n in null_counts(df, columns).first().asDict().items() if n}
    if broken:
        raise IntegrityError(f"{rule}: nulls per column {broken}")
