"""Left joins that stay balanced when a few keys carry most of the right side.

Adaptive execution can split the left (preserved) side of a skewed left join but
never the right one, so one key with a third of all right rows would end up in one
task. ``hot_keys`` counts the right side's keys and ``left_join`` spreads those above a
row count over salts. Salting only changes where a pair of rows meets; the joined rows
are those of the plain join, for any list of hot keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.sources.shared import shared_folder

# Right rows of one hot key that go to one salt.
ROWS_PER_SALT = 1_000_000
# Spread of left rows whose key is null; they match nothing wherever they go.
NULL_SALTS = 1 << 16
# Rows of a key at the limit that a sample holds on average; a quarter of them makes a candidate.
HITS = 64

_SALT, _SALTS, _HIT = "__salt", "__salts", "__hit"


def hot_keys(right: DataFrame, on: Sequence[str], min_rows: int = ROWS_PER_SALT,
             rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every key of ``right`` with ``min_rows`` rows or more, and its number of salts.

    Keys are counted before their shuffle, so a frequent one is one row for each task. There
    are at most as many hot keys as ``right`` has rows divided by ``min_rows``.
    """
    counts = right.dropna(subset=list(on)).groupBy(*on).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_rows).select(
        *on, F.ceil(F.col("n") / rows_per_salt).cast("int").alias(_SALTS))


def _candidates(right: DataFrame, on: Sequence[str], min_rows: int) -> DataFrame | None:
    """Keys that may have ``min_rows`` rows, from a sample; None if every key has to be counted.

    A key at the limit has ``HITS`` rows in the sample on average, and fewer than a quarter of
    that less than once in 10**12 times. One that is missed is joined without salts, with the
    same result.
    """
    share = HITS / min_rows
    if share >= 0.5:
        return None
    sample = right.select(*on).dropna().sample(share, seed=1)
    return sample.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") >= HITS // 4).select(*on)


def measured_hot_keys(right: DataFrame, on: Sequence[str] | str,
                      min_rows: int = ROWS_PER_SALT,
                      rows_per_salt: int = ROWS_PER_SALT) -> DataFrame | None:
    """The hot keys, counted once and stored in the shared folder, or ``None`` without any.

    A sample of the keys names candidates, and only their rows are counted. Both sides of a
    salted join must see the same salt counts, so the list is stored here rather than
    computed again on each side.
    """
    on = [on] if isinstance(on, str) else list(on)
    spark, folder = right.sparkSession, shared_folder(right.sparkSession)
    counted = right.select(*on)
    candidates = _candidates(right, on, min_rows)
    if candidates is not None:
        if candidates.isEmpty():
            return None
        path = f"{folder}/candidates-{uuid.uuid4().hex}"
        candidates.write.parquet(path)
        named = spark.read.schema(candidates.schema).parquet(path)
        counted = counted.join(named, on, "left_semi")
    path = f"{folder}/hot-{uuid.uuid4().hex}"
    hot = hot_keys(counted, on, min_rows, rows_per_salt)
    hot.write.parquet(path)
    stored = spark.read.schema(hot.schema).parquet(path)
    return None if stored.isEmpty() else stored


def _renamed(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in on})


def _equal(on: Sequence[str], left: str, right: str) -> Column:
    """The keys compared as a plain join of both sides would."""
    return reduce(Column.__and__, [F.col(left + c) == F.col(right + c) for c in on])


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str,
              hot: DataFrame | None = None, spread_by: Sequence[str] = ()) -> DataFrame:
    """``left.join(right, on, "left")``; with ``hot``, those keys are spread over salts.

    ``hot`` comes from ``measured_hot_keys``. Each right row of a hot key goes to one salt,
    chosen by the content of the row, so that a retried task repeats the choice. Equal rows
    choose alike: ``spread_by`` names columns of ``right`` that tell its rows apart and are
    not returned. Each left row of a hot key is repeated once per salt and the copies that
    meet no right row are dropped; a key that the right side does not hold is not hot,
    whatever the list says, so that no left row is lost.
    """
    on = [on] if isinstance(on, str) else list(on)
    if hot is None:
        return left.join(right.drop(*spread_by), on, "left")

    left_cols = left.columns
    right_cols = [c for c in right.columns if c not in on and c not in spread_by]
    # Spark broadcasts the list if it is small and else shuffles; no hint is given.
    listed = _renamed(hot, on, "__h_")
    held = _renamed(right.select(*on), on, "__r_")
    live = held.join(listed, _equal(on, "__r_", "__h_")).select(*listed.columns).distinct()

    of_right = _renamed(right, on, "__r_")
    spread_right = (
        of_right.join(live, _equal(on, "__r_", "__h_"), "left")
        .withColumn(_SALT, F.when(
            F.col(_SALTS).isNotNull(),
            F.pmod(F.xxhash64(*of_right.columns), F.col(_SALTS)).cast("int")).otherwise(0))
        .select(*["__r_" + c for c in on], F.col(_SALT).alias("__r_salt"), *right_cols,
                F.lit(True).alias(_HIT)))
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    salts = (
        F.when(F.col(_SALTS).isNotNull(), F.sequence(F.lit(0), F.col(_SALTS) - 1))
        .when(missing, F.array(F.pmod(F.xxhash64(*left_cols), F.lit(NULL_SALTS)).cast("int")))
        .otherwise(F.array(F.lit(0))))
    spread_left = (
        left.join(live, _equal(on, "", "__h_"), "left")
        .select(*left_cols, _SALTS, F.explode(salts).alias(_SALT)))
    joined = spread_left.join(
        spread_right, _equal(on, "", "__r_") & (F.col(_SALT) == F.col("__r_salt")), "left")
    return joined.filter(F.col(_SALTS).isNull() | F.col(_HIT)).select(
        *on, *[c for c in left_cols if c not in on], *right_cols)
