"""Pruned modes, inferred types, and profiles that add up over deliveries."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardmart.operators.profile import column_profile, pruned_modes
from wardmart.operators.states import Deliveries, profile_of_states, value_states
from wardmart.plans import silver
from wardmart.schemas import RAW
from wardmart.sources.infer import inferred_types, type_report, typed


def modes_of(rows, columns):
    out = {}
    for i, c in enumerate(columns):
        counts = Counter(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        out[f"mode_{c}"] = min(counts, key=lambda v: (-counts[v], v)) if counts else None
    return out


@pytest.mark.parametrize("buckets", [1, 7, 4096])
@pytest.mark.parametrize("seed", range(3))
def test_pruned_modes_equal_the_counted_ones(spark, seed, buckets):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(40)]), r.choice(["x", "y", "é", None]), r.choice([0.5, float("nan"), None, -1.0, 2.25]),
             r.randrange(1000), None) for _ in range(300)] + [(3, "x", 0.5, 7, None)] * 5
    columns = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, "a int, b string, c double, d bigint, e string").repartition(3)
    found = pruned_modes(df, columns, buckets).first().asDict()
    assert found == modes_of(rows, columns) == {
        k: v for k, v in column_profile(df, columns).first().asDict().items()}


def test_pruned_modes_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert pruned_modes(df, ["a", "b"]).first().asDict() == {"mode_a": None, "mode_b": None}


def test_inferred_types(spark):
    text = spark.createDataFrame([
        ("1", "3000000000", "1.5", "2024-02-29", "2024-02-29 10:11:12", "true", "x", None, "1", " 1"),
        ("-7", "1", "2e3", "2023-01-01", "2023-01-01T00:00:00.5", "FALSE", "1", None, "2024-02-30", "2"),
        (None, None, ".5", None, None, None, None, None, None, None)],
        "i string, l string, d string, day string, at string, yes string, t string, none string, mixed string, `od``d` string")
    assert inferred_types(text) == {
        "i": "int", "l": "bigint", "d": "double", "day": "date", "at": "timestamp", "yes": "boolean",
        "t": "string", "none": "string", "mixed": "string", "od`d": "string"}
    report = {(r["column"], r["type"]): r for r in type_report(text).collect()}
    assert report["l", "int"].n_misfits == 1 and report["l", "int"].least_misfit == "3000000000"
    assert report["mixed", "date"].n_misfits == 2 and report["mixed", "date"].least_misfit == "1"
    assert [r.n_values for k, r in report.items() if k[0] == "d"] == [3] * 7
    rows = typed(text, inferred_types(text))
    assert dict(rows.dtypes)["day"] == "date" and rows.first().l == 3000000000


def test_types_of_an_empty_table(spark):
    assert inferred_types(spark.createDataFrame([], "a string")) == {"a": "string"}
    assert inferred_types(spark.createDataFrame([], "a string").drop("a")) == {}


ROWS = [("a", 1, 0.5), ("b", 2, float("nan")), ("b", None, 0.25), (None, 2, None), ("a", 4, 0.25), ("c", 4, 1.0)]


def test_states_add_up(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "s string, i int, d double")
    stored, kinds = Deliveries(str(tmp_path / "s")), {c: df.schema[c].dataType for c in df.columns}
    for name, low, high in (("1", 0, 2), ("2", 2, 6), ("1", 0, 3), ("1", 0, 2)):  # the last ones replace the first
        stored.add(name, spark.createDataFrame(ROWS[low:high], df.schema), df.columns)
    found = profile_of_states(stored.states(spark), kinds, ["s", "i", "d"], ["i"]).first()
    assert found == column_profile(df, ["s", "i", "d"], ["i"]).first()
    assert sorted(map(tuple, value_states(df, ["d"]).collect())) == [("d", "0.25", 2), ("d", "0.5", 1), ("d", "1.0", 1)]


def test_an_empty_delivery_replaces_its_state(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "s string, i int, d double")
    stored, kinds = Deliveries(str(tmp_path / "s")), {"s": df.schema["s"].dataType}
    stored.add("1", df, ["s"])
    stored.add("1", df.where("false"), ["s"])
    assert profile_of_states(stored.states(spark), kinds, ["s"]).first().mode_s is None


def test_two_deliveries_are_filled_as_one(spark, tmp_path):
    """The second half, cleaned with the states of both, gets what cleaning all at once gives it."""
    rows = [(f"D{i}", f"n{i}", "x", None if i % 5 == 0 else ["eye", "heart", "skin"][i % 3 if i < 20 else 1],
             None, None if i % 4 == 0 else i, None, "e") for i in range(40)]
    raw = spark.createDataFrame(rows, RAW["doctors"])
    whole = {r.doctor_id: r for r in silver.clean_doctors(raw).collect()}
    states = Deliveries(str(tmp_path / "doctors"))
    number = F.replace("doctor_id", F.lit("D"), F.lit("")).cast("int")
    silver.clean_doctors(raw.where(number < 20), profiled=states.profiled("first"))
    second = silver.clean_doctors(raw.where(number >= 20), profiled=states.profiled("second")).collect()
    assert len(second) == 20 and all(r == whole[r.doctor_id] for r in second)
