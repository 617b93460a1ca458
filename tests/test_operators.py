"""Profiles, filling, joins, checks and key-based loads on small cases."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardmart.operators import impute, quality, upsert
from wardmart.operators.joins import hot_keys, left_join, measured_hot_keys
from wardmart.operators.profile import Profile, column_profile, most_common, value_counts


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Profiles

def test_mode_ignores_nulls_and_breaks_ties_low(spark):
    df = spark.createDataFrame(
        [("b", 1.5, 3), ("a", 2.5, 4), (None, 2.5, None), (None, None, None), ("c", None, 4)],
        "s string, f float, i int")
    row = column_profile(df, ["s", "f"], ["i"]).first()
    assert (row.mode_s, row.mode_f) == ("a", 2.5)
    assert row.mean_i == pytest.approx(11 / 3)


def test_profile_of_nothing_is_one_row_of_nulls(spark):
    empty = spark.createDataFrame([], "s string, i int")
    assert tuple(column_profile(empty, ["s"], ["i"]).first()) == (None, None)
    void = spark.createDataFrame([(None, None)], "s string, i int")
    assert tuple(column_profile(void, ["s"], ["i"]).first()) == (None, None)


def test_mode_and_mean_of_the_same_column(spark):
    df = spark.createDataFrame([(1,), (1,), (4,)], "i int")
    assert tuple(column_profile(df, ["i"], ["i"]).first()) == (1, 2.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z", None]),
                          st.one_of(st.none(), st.integers(-5, 5))), max_size=30))
def test_profile_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "s string, i int")
    row = column_profile(df, ["s", "i"], ["i"]).first()

    def top(vals):
        vals = [v for v in vals if v is not None]
        return min(vals, key=lambda v: (-vals.count(v), v)) if vals else None

    numbers = [i for _, i in data if i is not None]
    assert row.mode_s == top([s for s, _ in data])
    assert row.mode_i == top([i for _, i in data])
    expected = sum(numbers) / len(numbers) if numbers else None
    assert row.mean_i == pytest.approx(expected) if numbers else row.mean_i is None


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    assert [tuple(r) for r in value_counts(df, "s").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [tuple(r) for r in most_common(df, "s").collect()] == [("c", 2)]


def test_fallbacks(spark):
    void = spark.createDataFrame([(1, None, None)], "k int, s string, n int")
    profile = Profile(void, ["s", "n"], ["n"])
    found = impute.fill(void, {"s": profile.mode("s", "UNKNOWN"), "n": profile.mode("n")})
    assert rows(found) == [(1, "UNKNOWN", None)]
    assert rows(impute.fill(void, {"n": profile.whole_mean("n")})) == [(1, None, 0)]


def test_mean_is_cut_toward_zero(spark):
    df = spark.createDataFrame([(-1,), (-2,), (None,)], "n int")
    profile = Profile(df, [], ["n"])
    assert rows(impute.fill(df, {"n": profile.whole_mean("n")})) == [(-1,), (-1,), (-2,)]


# Filling and row cleaning

def test_drop_empty_keeps_rows_with_one_key(spark):
    df = spark.createDataFrame([(None, None, 1), ("a", None, 2), (None, "b", 3)],
                               "x string, y string, z int")
    assert [r.z for r in impute.drop_empty(df, ["x", "y"]).orderBy("z").collect()] == [2, 3]


def test_deduplicate_whole_rows_only(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, None), (None, None)],
                               "x string, y int")
    assert impute.deduplicate(df).count() == 3


def test_fill_constants_refuses_wrong_type(spark):
    df = spark.createDataFrame([(None, None)], "phone bigint, name string")
    with pytest.raises(TypeError):
        impute.fill_constants(df, {"phone": "UNKNOWN"})
    with pytest.raises(TypeError):
        impute.fill_constants(df, {"name": 1})
    assert rows(impute.fill_constants(df, {"phone": 1, "name": "x"})) == [(1, "x")]


def test_fill_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "c float")
    assert rows(impute.fill(df, {"c": F.lit(1.0).cast("float")})) == [(1.0,), (1.0,), (2.0,)]


# Joins

def _sides(spark):
    left = spark.createDataFrame(
        [(k, p) for p, k in enumerate([1, 1, 2, 3, None, None, 7, 9])], "k int, p int")
    right = spark.createDataFrame(
        [(7, i) for i in range(500)] + [(1, i) for i in range(30)] + [(2, 0), (None, 5), (4, 1)],
        "k int, q int")
    return left, right


def test_hot_keys_finds_the_heavy_ones(spark):
    _, right = _sides(spark)
    found = {tuple(r) for r in hot_keys(right, ["k"], min_rows=20, rows_per_salt=100).collect()}
    assert found == {(7, 5), (1, 1)}


def test_no_hot_keys_means_a_plain_join(spark):
    left, right = _sides(spark)
    assert measured_hot_keys(right, "k") is None


def test_salted_join_equals_plain_join(spark):
    left, right = _sides(spark)
    hot = measured_hot_keys(right, "k", min_rows=20, rows_per_salt=10)
    salted = left_join(left, right, "k", hot)
    assert salted.columns == ["k", "p", "q"]
    assert rows(salted) == rows(left.join(right, "k", "left"))


def test_salted_composite_join_equals_plain_join(spark):
    left = spark.createDataFrame(
        [(1, 2, "a"), (1, None, "b"), (None, 2, "c"), (-1, -2, "d"), (5, 6, "e")],
        "x int, y int, p string")
    right = spark.createDataFrame(
        [(1, 2, i) for i in range(200)] + [(-1, -2, i) for i in range(100)] + [(None, 2, 0)],
        "x int, y int, q int")
    hot = measured_hot_keys(right, ["x", "y"], min_rows=50, rows_per_salt=9)
    assert hot.count() == 2
    assert rows(left_join(left, right, ["x", "y"], hot)) == rows(
        left.join(right, ["x", "y"], "left"))


@pytest.mark.parametrize("left_kind, right_kind", [
    ("int", "string"), ("double", "float"), ("bigint", "int"), ("string", "int"), ("date", "date")])
def test_salted_join_of_unlike_key_types(spark, left_kind, right_kind):
    def key(kind):
        return F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")) if kind == "date" \
            else F.col("id").cast(kind)
    left = spark.range(6).select(key(left_kind).alias("k"), F.col("id").alias("p"))
    right = spark.range(400).select(F.col("id"), (F.col("id") % 4).alias("m")).select(
        F.col("id").alias("q"), F.col("m").alias("id")).select(key(right_kind).alias("k"), "q")
    hot = measured_hot_keys(right, "k", min_rows=20, rows_per_salt=10)
    assert hot.count() == 4
    assert rows(left_join(left, right, "k", hot)) == rows(left.join(right, "k", "left"))


def test_a_stale_hot_list_loses_no_row(spark):
    left, right = _sides(spark)
    hot = measured_hot_keys(right, "k", min_rows=20, rows_per_salt=10)
    now = right.filter("k <> 7")
    assert rows(left_join(left, now, "k", hot)) == rows(left.join(now, "k", "left"))


def test_equal_right_rows_are_spread(spark):
    left = spark.createDataFrame([(7, "x")], "k int, p string")
    right = spark.range(50000).select(F.lit(7).alias("k"), F.lit(5.0).alias("amount"), F.col("id").alias("bill"))
    hot = measured_hot_keys(right, "k", min_rows=1000, rows_per_salt=1000)
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(names[0], False)
    spark.conf.set(names[1], -1)
    try:
        joined = left_join(left, right, "k", hot, spread_by=["bill"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in names:
            spark.conf.unset(name)
    assert joined.columns == ["k", "p", "amount"]
    assert sum(sizes) == 50000 and len(sizes) > 4 and max(sizes) < 25000


def test_salted_text_keys(spark):
    left = spark.createDataFrame([("a", "b", 1), ("a,", "b", 2), ("a", None, 3)],
                                 "x string, y string, p int")
    right = spark.createDataFrame([("a", "b", i) for i in range(60)], "x string, y string, q int")
    hot = measured_hot_keys(right, ["x", "y"], min_rows=50, rows_per_salt=7)
    assert rows(left_join(left, right, ["x", "y"], hot)) == rows(
        left.join(right, ["x", "y"], "left"))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=15),
       st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=60))
def test_any_salted_join_equals_plain_join(spark, lk, rk):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lk)], "k int, p int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rk)], "k int, q int")
    hot = measured_hot_keys(right, "k", min_rows=3, rows_per_salt=2)
    assert rows(left_join(left, right, "k", hot)) == rows(left.join(right, "k", "left"))


def test_hot_key_is_spread(spark):
    """A third of the right side under one key must not meet in one partition."""
    right = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").alias("q"))
    left = spark.createDataFrame([(7, "x"), (8, "y")], "k int, p string")
    hot = measured_hot_keys(right, "k", min_rows=1000, rows_per_salt=500)

    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    coalesce, broadcast = ("spark.sql.adaptive.coalescePartitions.enabled",
                           "spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(coalesce, False)
    spark.conf.set(broadcast, -1)
    try:
        plain, salted = sizes(left_join(left, right, "k")), sizes(left_join(left, right, "k", hot))
    finally:
        spark.conf.unset(coalesce)
        spark.conf.unset(broadcast)
    assert sum(plain) == sum(salted) == 10002
    assert max(plain) >= 10001
    assert max(salted) < 4000


# Checks

def test_pk_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(quality.pk_violations(df, "k")) == [(1, 2), (None, 1)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(quality.null_counts(df, ["a", "b"])) == [(1, 2)]


def test_fk_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (1, None), (2, 11), (2, 11), (None, 10)], "d int, t int")
    dims = {"d": (spark.createDataFrame([(1,)], "id int"), "id"),
            "t": (spark.createDataFrame([(10,)], "tid int"), "tid")}
    assert rows(quality.fk_orphans(fact, dims)) == [("d", 2, 2), ("t", 11, 2)]


def test_require_none(spark):
    bad = spark.createDataFrame([(1, 2)], "k int, n int")
    with pytest.raises(quality.IntegrityError, match="primary key.*'k': 1"):
        quality.require_none(bad, "primary key")
    quality.require_none(bad.filter("k > 1"), "primary key")
    with pytest.raises(quality.IntegrityError, match="'b': 1"):
        quality.require_no_nulls(spark.createDataFrame([(1, None)], "a int, b int"),
                                 ["a", "b"], "not null")


# Absent keys

def test_absent_rows(spark):
    new = spark.createDataFrame([(1, "z"), (1, "a"), (2, "b"), (3, None)], "k int, v string")
    held = spark.createDataFrame([(2, "old")], "k int, v string")
    assert rows(upsert.absent_rows(new, held, "k")) == [(1, "a"), (3, None)]
    assert rows(upsert.absent_rows(new, None, "k")) == [(1, "a"), (2, "b"), (3, None)]


def test_one_per_key_of_a_key_only_table(spark):
    new = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(upsert.one_per_key(new, "k")) == [(1,), (2,)]


@pytest.mark.parametrize("modes", [["k"], []])
def test_mean_of_large_numbers_and_of_nan(spark, modes):
    rows = spark.createDataFrame(
        [("a", 9 * 10**18, 1.0), ("a", 9 * 10**18, float("nan")), ("b", None, 3.0)], "k string, n long, x double")
    found = column_profile(rows, modes, ["n", "x"]).first()
    assert (found.mean_n, found.mean_x) == (9e18, 2.0)


def test_nan_is_no_mode(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert column_profile(rows, ["x"]).first().mode_x == 1.0
