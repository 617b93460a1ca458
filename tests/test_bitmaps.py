"""Key bitmaps: uniqueness, membership, and the stored index of a target."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from wardmart.operators.bitmaps import key_bitmaps, merged, not_in, pk_violations_by_bitmap
from wardmart.operators.quality import IntegrityError, pk_violations
from wardmart.sources import published, targets
from wardmart.sources.targets import IndexedParquetTarget, load

EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2 ** 31, -2 ** 31, 2 ** 63 - 1, -2 ** 63 + 1]


def keys(spark, values, kind="bigint"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, v int").repartition(3)


@pytest.mark.parametrize("values", [
    EDGES, EDGES + [0, 32768, -32768, 2 ** 63 - 1], EDGES + [None], [None, None, 3, 3, 3], [], [5] * 1000 + [6]])
def test_violations_equal_the_grouped_ones(spark, values):
    df = keys(spark, values)
    found, expected = pk_violations_by_bitmap(df, "k"), pk_violations(df, "k")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.dtypes == expected.dtypes


def test_violations_of_small_keys_and_of_text(spark):
    df = keys(spark, [1, 1, None, -5], "int")
    assert sorted(map(str, pk_violations_by_bitmap(df, "k").collect())) == sorted(
        map(str, pk_violations(df, "k").collect()))
    with pytest.raises(TypeError, match="whole number"):
        pk_violations_by_bitmap(df.withColumn("k", F.col("k").cast("string")), "k")


def test_ordered_keys_shuffle_few_rows(spark):
    """A unique key in order: what leaves the tasks are bitmaps, a row for 32,768 keys."""
    df = spark.range(0, 300_000, 1, 4).withColumnRenamed("id", "k")
    out = pk_violations_by_bitmap(df, "k")
    assert out.count() == 0
    assert key_bitmaps(df, "k").count() == 11


def test_membership(spark):
    one, two = key_bitmaps(keys(spark, EDGES[:7]), "k"), key_bitmaps(keys(spark, EDGES[7:] + [None]), "k")
    both = merged(one, two)
    asked = keys(spark, EDGES + [2, -2, 32766, -32770, 2 ** 62, None])
    assert sorted(r.k for r in not_in(asked, "k", one).collect() if r.k is not None) == sorted(
        EDGES[7:] + [2, -2, 32766, -32770, 2 ** 62])
    left = [r.k for r in not_in(asked, "k", both).collect()]
    assert sorted(x for x in left if x is not None) == [-32770, -2, 2, 32766, 2 ** 62] and left.count(None) == 1


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, v string")


def loaded(target, spark):
    return sorted(map(tuple, target.read(spark, "t").collect()))


def test_index_loads_equal_plain_ones(spark, tmp_path):
    target = IndexedParquetTarget(str(tmp_path))
    for pairs in ([(1, "a"), (2, "b")], [(2, "x"), (3, "c"), (3, "d")], [(2, "x"), (3, "c")], []):
        load(rows(spark, pairs), target, "t", "k")
    assert loaded(target, spark) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(IntegrityError, match="without a key"):
        load(rows(spark, [(None, "z")]), target, "t", "k")


def test_a_second_load_reads_no_row_of_the_target(spark, tmp_path, monkeypatch):
    target = IndexedParquetTarget(str(tmp_path))
    load(rows(spark, [(1, "a")]), target, "t", "k")
    index = published.current(spark, f"{tmp_path}/_keys/t")
    held = target.held_keys(spark, "t", "k")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        not_in(rows(spark, [(2, "b")]), "k", held).explain("formatted")
    assert index.path.rsplit("/", 1)[1] in out.getvalue() and f"{tmp_path}/t]" not in out.getvalue()
    # No index is made from the target's keys again.
    calls = []
    real = targets.key_bitmaps
    monkeypatch.setattr(targets, "key_bitmaps", lambda df, key: calls.append(df) or real(df, key))
    load(rows(spark, [(2, "b")]), target, "t", "k")
    assert len(calls) == 1 and calls[0].count() == 1  # the new rows only
    assert loaded(target, spark) == [(1, "a"), (2, "b")]


def test_a_half_written_load_completes(spark, tmp_path):
    """Rows that arrived without the index's knowledge are neither lost nor doubled."""
    target = IndexedParquetTarget(str(tmp_path))
    load(rows(spark, [(1, "a")]), target, "t", "k")
    target.append(rows(spark, [(2, "b")]), "t")  # a load that stopped before its index
    load(rows(spark, [(2, "b"), (3, "c")]), target, "t", "k")
    assert loaded(target, spark) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_lost_index_is_built_again(spark, tmp_path):
    target = IndexedParquetTarget(str(tmp_path))
    load(rows(spark, [(1, "a"), (-7, "m")]), target, "t", "k")
    os.rename(tmp_path / "_keys", tmp_path / "elsewhere")
    load(rows(spark, [(1, "x"), (-7, "x"), (2, "b")]), target, "t", "k")
    assert loaded(target, spark) == [(-7, "m"), (1, "a"), (2, "b")]


def test_index_follows_a_replacing_load(spark, tmp_path):
    target = IndexedParquetTarget(str(tmp_path))
    load(rows(spark, [(1, "a"), (2, "b")]), target, "t", "k")
    load(rows(spark, [(2, "new")]), target, "t", "k", "replace")
    load(rows(spark, [(1, "again"), (2, "late")]), target, "t", "k")
    assert loaded(target, spark) == [(1, "again"), (2, "new")]


def test_text_keys_load_without_an_index(spark, tmp_path):
    target = IndexedParquetTarget(str(tmp_path))
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for _ in range(2):
        load(df, target, "t", "k")
    assert target.read(spark, "t").count() == 1 and not os.path.exists(tmp_path / "_keys")
