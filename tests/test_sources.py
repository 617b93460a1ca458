"""Files, JDBC options and load modes. JDBC is checked up to the options it sends."""

from __future__ import annotations

import pytest

from wardmart.functions.calendar import calendar
from wardmart.sources import files, jdbc
from wardmart.sources.shared import shared_folder
from wardmart.sources.targets import JdbcTarget, ParquetTarget, load


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,d,n\nA1,2024-02-29,1\nA2,garbage,x\n,,\n")
    schema = spark.createDataFrame([], "k string, d date, n int").schema
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert [(r.k, r.d is None, r.n) for r in rows] == [
        ("A1", False, 1), ("A2", True, None), (None, True, None)]


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("x,y\n1,2\n")
    schema = spark.createDataFrame([], "k string, n int").schema
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path / "t.csv"), schema).collect()


def test_csv_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,n,d\nA1,1,2024-02-29\n")
    found = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(found.dtypes) == {"k": "string", "n": "int", "d": "date"}


def test_parquet_modes(spark, tmp_path):
    path, df = str(tmp_path / "p"), spark.range(3)
    assert files.read_parquet_if_exists(spark, path) is None
    files.write_parquet(df, path, "ignore")
    files.write_parquet(spark.range(9), path, "ignore")
    assert files.read_parquet(spark, path).count() == 3
    files.write_parquet(df, path, "append")
    assert files.read_parquet(spark, path).count() == 6
    files.write_parquet(spark.range(1), path)
    assert files.read_parquet_if_exists(spark, path).count() == 1


def test_loading_twice_equals_loading_once(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    more = spark.createDataFrame([(2, "changed"), (3, "c")], "k int, v string")
    for df in (first, first, more, more):
        load(df, target, "t", "k")
    assert sorted(map(tuple, target.read(spark, "t").collect())) == [
        (1, "a"), (2, "b"), (3, "c")]


def test_replace_and_append(spark, tmp_path):
    target, df = ParquetTarget(str(tmp_path)), spark.range(2)
    load(df, target, "t", "id", "append")
    load(df, target, "t", "id", "append")
    assert target.read(spark, "t").count() == 4
    load(df, target, "t", "id", "replace")
    assert target.read(spark, "t").count() == 2
    with pytest.raises(ValueError, match="upsert"):
        load(df, target, "t", "id", "upsert")


def test_a_longer_calendar_adds_only_new_days(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    for end in ("2024-01-10", "2024-01-10", "2024-02-05"):
        load(calendar(spark, "2024-01-01", end), target, "dim_date", "date_id")
    held = target.read(spark, "dim_date")
    assert held.count() == held.select("date_id").distinct().count() == 36


class Recorder:
    """Stands for a session or a DataFrame and notes what a writer or reader is told."""

    def __init__(self):
        self.told = {}
        self.read = self.write = self

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told["options"] = options
        return self

    def repartition(self, n):
        self.told["partitions"] = n
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def save(self):
        self.told["done"] = "save"

    def load(self):
        return self


CONNECTION = jdbc.JdbcConnection("jdbc:x://h/db", "x.Driver", "u", "secret", 500, 4)


def test_jdbc_append():
    r = Recorder()
    jdbc.append_table(r, CONNECTION, "t")
    assert r.told["format"] == "jdbc" and r.told["mode"] == "append" and r.told["done"]
    assert r.told["options"] == {
        "url": "jdbc:x://h/db", "driver": "x.Driver", "dbtable": "t", "user": "u",
        "password": "secret", "batchsize": "500", "numPartitions": "4"}
    assert r.told["partitions"] == 4  # else all work before the write runs in four tasks


def test_jdbc_replace_keeps_the_table():
    r = Recorder()
    jdbc.replace_table(r, CONNECTION, "t")
    assert r.told["mode"] == "overwrite" and r.told["options"]["truncate"] == "true"


def test_jdbc_split_read():
    r = Recorder()
    target = JdbcTarget(CONNECTION, {"t": jdbc.KeyRange("k", 1, 100, 8)})
    target.read(r, "t")
    told = r.told["options"]
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"],
            told["numPartitions"]) == ("k", "1", "100", "8")
    target.read(r, "other")
    assert "partitionColumn" not in r.told["options"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("more,n,id\nx,2.5,A1\ny,7,A2\n")
    schema = spark.createDataFrame([], "id string, n int").schema
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), schema)
    assert rows.columns == ["id", "n", "more"]
    assert [r.more for r in rows.collect()] == ["x", "y"]
    assert rows.where("id = 'A2'").first().n == 7
    with pytest.raises(ValueError, match="absent"):
        files.read_csv(spark, str(tmp_path / "t.csv"), schema.add("absent", "string"))


def test_password_is_not_shown():
    assert "secret" not in repr(CONNECTION) + repr(JdbcTarget(CONNECTION))


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_without_a_key_are_refused(spark, tmp_path):
    from wardmart.operators.quality import IntegrityError

    target = ParquetTarget(str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(IntegrityError, match="without a key"):
        load(df, target, "t", "k")
    assert target.read(spark, "t") is None
