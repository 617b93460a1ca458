"""Published copies: what a failing write, two writers and buckets leave behind."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from wardmart.sources import files, published
from wardmart.sources.published import Buckets
from wardmart.sources.targets import ParquetTarget, load


def failing(spark, n=100):
    """Rows of which one cannot be computed, in a task that writes others before it."""
    return spark.range(0, n, 1, 2).select(
        F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_failed_overwrite_keeps_the_last_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.range(7), path)
    before = published.current(spark, path)
    with pytest.raises(Exception, match="broken"):
        files.write_parquet(failing(spark), path)
    assert published.current(spark, path) == before
    assert files.read_parquet(spark, path).count() == 7
    assert sorted(os.listdir(path)) == sorted([published.LEDGER, os.path.basename(before.path)])  # nothing left over
    files.write_parquet(spark.range(3), path)
    assert files.read_parquet(spark, path).count() == 3


def test_a_table_can_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.range(7), path)
    files.write_parquet(files.read_parquet(spark, path).where("id > 2"), path)
    assert files.read_parquet(spark, path).count() == 4


def test_a_failed_replacing_load_keeps_the_rows(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    load(spark.range(4), target, "t", "id", "append")  # plain files, no copy yet
    with pytest.raises(Exception, match="broken"):
        load(failing(spark), target, "t", "id", "replace")
    assert target.read(spark, "t").count() == 4
    load(spark.range(9), target, "t", "id", "replace")
    load(spark.range(9, 11), target, "t", "id", "append")
    assert target.read(spark, "t").count() == 11


def test_a_failed_check_keeps_the_last_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(spark.range(2), path, "one")

    def refuse():
        raise ValueError("too many")

    with pytest.raises(ValueError, match="too many"):
        published.publish(spark.range(5), path, "two", check=refuse)
    copy = published.current(spark, path)
    assert (copy.number, copy.made_from) == (1, "one")
    assert published.opened(spark, copy).count() == 2


def test_two_writers_at_once_both_finish(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one = published.publish(spark.range(1), path)
    monkeypatch.setattr(published, "copies", lambda *_: [one])  # both saw the first copy
    two, three = published.publish(spark.range(2), path), published.publish(spark.range(3), path)
    monkeypatch.undo()
    assert two.number == three.number == 2
    last = published.current(spark, path)
    assert last.path == max(two.path, three.path)
    assert published.opened(spark, last).count() in (2, 3)


def test_only_the_last_copies_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    made = [published.publish(spark.range(n), path) for n in range(1, 5)]
    there = [os.path.exists(c.path) for c in made]
    assert there == [False, False, True, True]
    assert published.opened(spark, made[2]).count() == 3


def test_no_ledger(spark, tmp_path):
    assert published.copies(spark, str(tmp_path / "none")) == []
    assert published.current(spark, str(tmp_path / "none")) is None


def test_fingerprint_follows_the_files(spark, tmp_path):
    path = tmp_path / "f"
    path.mkdir()
    (path / "a").write_text("1")
    one = published.fingerprint(spark, [str(path)])
    assert one == published.fingerprint(spark, [str(path)])
    (path / "b").write_text("2")
    two = published.fingerprint(spark, [str(path)])
    (path / "b").write_text("23")
    assert len({one, two, published.fingerprint(spark, [str(path)])}) == 3


def test_buckets(spark, tmp_path):
    """One file a bucket; another session's catalog learns of the copy when it is opened."""
    path = str(tmp_path / "it's")
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id").alias("odd name"))
    copy = published.publish(df, path, buckets=Buckets(("k",), 4))
    assert len([f for f in os.listdir(copy.path) if f.endswith(".parquet")]) == 4
    spark.sql(f"drop table {copy.table}")
    again = published.opened(spark, published.current(spark, path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="bucketed"):
        files.write_parquet(df, path, "append")
    files.write_parquet(df.where("k < 3"), path)
    assert published.current(spark, path).buckets == Buckets(("k",), 4)
