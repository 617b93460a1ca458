"""Sets of whole-number keys as bitmaps, one for each run of 32,768 numbers.

A bitmap takes 4 kB however many of its keys are there, so these pay where keys lie densely:
counted per task before the shuffle, where rows arrive more or less in the order of their keys
(``pk_violations_by_bitmap``), or over whole tables, where they are numbered in a row
(``key_bitmaps``, the index of a target).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET, _BIT, _MAP = "bucket", "bit", "bits"


def is_whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.IntegralType)


def _bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("bigint"))


def _bit(key: str) -> Column:
    return F.bitmap_bit_position(F.col(key).cast("bigint"))


def pk_violations_by_bitmap(df: DataFrame, key: str) -> DataFrame:
    """``quality.pk_violations(df, key)`` for a whole-number key, without shuffling every key.

    Each task turns its keys into bitmaps with their row counts. A bucket that holds as many
    rows as bits holds each key once; only the rows of the other buckets, and those without a
    key, are grouped by key. Where rows come in no order of the key, a task has a bitmap for
    every bucket and grouping all keys is cheaper.
    """
    if not is_whole(df, key):
        raise TypeError(f"{key} is {df.schema[key].dataType.simpleString()}, not a whole number")
    keys = df.select(key)
    known = keys.where(F.col(key).isNotNull())
    suspects = (
        known.select(_bucket(key).alias(_BUCKET), _bit(key).alias(_BIT))
        .groupBy(_BUCKET).agg(F.count("*").alias("n"), F.bitmap_construct_agg(_BIT).alias(_MAP))
        .where(F.col("n") > F.bitmap_count(_MAP)).select(_BUCKET))
    repeated = (
        known.withColumn(_BUCKET, _bucket(key)).join(suspects, _BUCKET, "left_semi")
        .groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1))
    kind = df.schema[key].dataType
    missing = (keys.where(F.col(key).isNull()).agg(F.count("*").alias("n")).where(F.col("n") > 0)
               .select(F.lit(None).cast(kind).alias(key), "n"))
    return repeated.unionAll(missing)


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """bucket and bits of all keys of ``df``, which has each key once; null keys are left out.

    Keys meet by bucket before they become bits, so that rows in any order make each bitmap once.
    A bucket has 32,768 keys at most, so none is large.
    """
    return (
        df.where(F.col(key).isNotNull()).select(_bucket(key).alias(_BUCKET), _bit(key).alias(_BIT))
        .repartition(_BUCKET).groupBy(_BUCKET).agg(F.bitmap_construct_agg(_BIT).alias(_MAP)))


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The keys of either set."""
    return one.unionByName(other).groupBy(_BUCKET).agg(F.bitmap_or_agg(_MAP).alias(_MAP))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (bit % 8).cast("int")) == 1


def not_in(df: DataFrame, key: str, held: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key the set does not hold; those without a key are among them."""
    numbered = df.withColumns({"__" + _BUCKET: _bucket(key), "__" + _BIT: _bit(key)})
    listed = held.select(F.col(_BUCKET).alias("__h_" + _BUCKET), F.col(_MAP).alias("__h_" + _MAP))
    same = (F.col("__" + _BUCKET) == F.col("__h_" + _BUCKET)) & _is_set(F.col("__h_" + _MAP), F.col("__" + _BIT))
    return numbered.join(listed, same, "left_anti").select(*df.columns)
