"""Values that casts lose: kept beside their rows, counted by the write, limited by the run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardmart.operators.rejects import REJECTED, Account, RejectedValues, convert, rejects
from wardmart.sources import files, published

TEXT = "k,d,n,x\nA1,2024-02-29,1,a\nA2,garbage,x,b\n,,,c\nA3,2024-02-30,7,d\n"


@pytest.fixture
def source(tmp_path):
    (tmp_path / "t.csv").write_text(TEXT)
    return str(tmp_path / "t.csv")


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], "k string, d date, n int").schema


def test_csv_keeps_what_it_rejects(spark, source, schema):
    rows = files.read_csv(spark, source, schema, REJECTED)
    assert rows.columns == ["k", "d", "n", "x", REJECTED]
    lost = sorted(map(tuple, rejects(rows, ["k"]).collect()))
    assert lost == [("A2", "d", "garbage"), ("A2", "n", "x"), ("A3", "d", "2024-02-30")]
    assert rows.where(f"{REJECTED} is null").count() == 2


def test_csv_of_text_alone_rejects_nothing(spark, source):
    schema = spark.createDataFrame([], "k string").schema
    assert rejects(files.read_csv(spark, source, schema, REJECTED), ["k"]).count() == 0


def test_the_write_counts(spark, source, schema, tmp_path):
    account = Account("t", ["d", "n"])
    published.publish(account.watch(files.read_csv(spark, source, schema, REJECTED)), str(tmp_path / "t"))
    assert account.rows == 4 and account.rejected == {"d": 2, "n": 1}
    account.require_at_most(None)
    account.require_at_most(3)
    with pytest.raises(RejectedValues, match=r"t: 3 rejected values, 2 allowed: \{'d': 2, 'n': 1\}"):
        account.require_at_most(2)


def test_the_source_is_scanned_once(spark, source, schema):
    rows = Account("t", ["d", "n"]).watch(files.read_csv(spark, source, schema, REJECTED))
    text = rows._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan"):]
    assert physical.count("FileScan csv") == 1 and "CollectMetrics" in physical


def test_an_empty_table_has_an_account(spark, tmp_path):
    account = Account("t", ["d"])
    rows = spark.createDataFrame([], f"d date, {REJECTED} array<struct<column:string,raw:string>>")
    published.publish(account.watch(rows), str(tmp_path / "t"))
    assert account.rows == 0 and account.rejected == {"d": 0}


def test_convert_adds_to_what_was_lost(spark):
    df = spark.createDataFrame([("1", "x", None), ("y", None, "7"), (None, "2", "3")], "a string, b string, c string")
    once = convert(df, {"a": F.col("a").try_cast("int")}, into="lost")
    twice = convert(once, {"b": F.col("b").try_cast("int"), "e": F.col("c").try_cast("int") + 1},
                    raw={"e": F.col("c")}, into="lost")
    found = [(r.a, r.b, r.e, r.lost and [tuple(x) for x in r.lost]) for r in twice.collect()]
    assert found == [(1, None, None, [("b", "x")]), (None, None, 8, [("a", "y")]), (None, 2, 4, None)]
    assert convert(df, {"a": F.col("a").try_cast("int")}).columns == df.columns
