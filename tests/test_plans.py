"""What the physical plans must and must not hold."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as registry
from wardmart.operators import joins
from wardmart.operators.joins import left_join, measured_hot_keys
from wardmart.operators.profile import column_profile, pruned_counts, pruned_modes
from wardmart.operators.quality import fk_orphans
from wardmart.operators.upsert import absent_rows
from wardmart.plans import gold, silver
from wardmart.schemas import RAW
from wardmart.sources import published
from workload import clinic

SF = str(TESTDATA / "sf0.001")
pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables here")

# These write tables when they are called; their result is a plain scan.
WRITERS = {"q_csv_parquet_roundtrip", "q_csv_infer_schema", "q_write_ignore",
           "q_write_replace", "q_insert_if_absent", "q_medallion_fact", "q_medallion_doctors",
           "q_medallion_patients", "q_medallion_treatments", "q_medallion_date",
           "q_rejected_values", "q_rejected_counts", "q_infer_types", "q_insert_by_index"}


def plan(df, mode=None):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode) if mode else df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - WRITERS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text


def plan_after(df):
    df.collect()
    return plan(df)


TEXTS = {"doctors": clinic.doctors(), "appointments": clinic.appointments(),
         "billing": clinic.billing_lines(), "treatments": clinic.treatment_lines()}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_cleaner_deduplicates_once(spark, tmp_path, name):
    """The statistics and the rows share one shuffle of the deduplication."""
    clinic.rows(spark, SF, TEXTS[name], name).write.parquet(str(tmp_path / name))
    raw = spark.read.schema(RAW[name]).parquet(str(tmp_path / name))
    text = plan_after(silver.CLEANERS[name](raw, "2024-01-01"))
    assert "ReusedExchange" in text and "ReusedSubquery" in text


def test_patient_statistics_read_three_columns(spark, tmp_path):
    clinic.rows(spark, SF, clinic.patients(), "patients").write.parquet(str(tmp_path / "p"))
    raw = spark.read.schema(RAW["patients"]).parquet(str(tmp_path / "p"))
    text = plan(silver.clean_patients(raw, "2024-01-01"), "formatted")
    narrow = "ReadSchema: struct<gender:string,date_of_birth:date,insurance_provider:string>"
    assert narrow in text


def test_profile_is_one_scan_of_its_columns(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(column_profile(lines, ["l_returnflag", "l_linestatus"], ["l_linenumber"]),
                "formatted")
    assert text.count("Scan parquet") == 2          # once in the tree, once in the details
    schema = "struct<l_linenumber:int,l_returnflag:string,l_linestatus:string>"
    assert f"ReadSchema: {schema}" in text
    assert "partial_count(1)" in text


def test_fact_reads_and_shuffles_only_what_it_returns(spark, tmp_path):
    for name, text in (("appointments", clinic.appointments()),
                       ("treatments", clinic.treatments()), ("billing", clinic.billing())):
        silver.CLEANERS[name](clinic.rows(spark, SF, text, name), "2024-01-01").write.parquet(
            str(tmp_path / name))
    a, t, b = (spark.read.parquet(str(tmp_path / n))
               for n in ("appointments", "treatments", "billing"))
    text = plan(gold.fact_appointments(a, t, b), "formatted")
    assert "ReadSchema: struct<treatment_id:bigint,appointment_id:bigint>" in text
    assert "ReadSchema: struct<patient_id:bigint,treatment_id:bigint,amount:float>" in text
    assert "appointment_time:" not in text
    assert "PushedFilters: [IsNotNull(appointment_id)]" in text
    assert "Window" not in text and "Sort " not in text.replace("SortMergeJoin", "")


def test_anti_joins_shuffle_each_side_once(spark):
    """Counting or deduplicating by key leaves the rows where the join needs them."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        absent = plan(absent_rows(
            orders, lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", True))
        orphans = plan(fk_orphans(lines, {
            "l_orderkey": (orders, "o_orderkey"),
            "l_suppkey": (spark.read.parquet(f"{SF}/supplier.parquet"), "s_suppkey")}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert absent.count("Exchange") == orphans.count("Exchange") == 2
    assert "LeftAnti" in absent and "LeftAnti" in orphans
    assert "partial_count" in orphans


def test_not_null_filter_reaches_the_scan(spark):
    rows = spark.read.parquet(f"{SF}/customer.parquet")
    text = plan(rows.filter(F.col("c_mktsegment").isNotNull()), "formatted")
    assert "PushedFilters: [IsNotNull(c_mktsegment)]" in text


def test_nothing_is_broadcast_by_hint(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_type", "event_id")
    hot = measured_hot_keys(events, "event_type", min_rows=10, rows_per_salt=10)
    left = events.groupBy("event_type").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(left_join(left, events, "event_type", hot))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text
    assert "SortMergeJoin" in text and "__salt" in text


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    """No Exchange below the fact's first join, and none of bills below the second."""
    buckets = {"appointments": ("appointment_id",), "treatments": ("appointment_id",),
               "billing": ("patient_id", "treatment_id")}
    texts = {"appointments": clinic.appointments(), "treatments": clinic.treatments(), "billing": clinic.billing()}
    opened = [
        published.opened(spark, published.publish(
            silver.CLEANERS[name](clinic.rows(spark, SF, texts[name], name), "2024-01-01"),
            str(tmp_path / name), buckets=published.Buckets(columns, 8)))
        for name, columns in buckets.items()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fact = gold.fact_appointments(*opened)
        text = plan(fact)
        assert text.count("SortMergeJoin") == 2
        assert text.count("Exchange") == 1  # what the first join returns, for the second
        first = text[text.rindex("SortMergeJoin"):]
        assert first.count("Bucketed: true") >= 2 or first.count("SelectedBucketsCount: 8 out of 8") >= 2
        assert "Exchange" not in first
        counts = plan(opened[1].groupBy("appointment_id").count())
        assert "Exchange" not in counts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_of_a_large_limit_shuffle_a_sample(spark):
    """Without candidates no key is counted, and nothing is stored."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert measured_hot_keys(lines, "l_orderkey") is None
    text = plan(joins._candidates(lines, ["l_orderkey"], 1_000_000))
    assert "Sample 0.0, 6.4E-5" in text and text.index("Exchange") < text.index("Sample")
    assert joins._candidates(lines, ["l_orderkey"], 100) is None


def test_pruned_modes_shuffle_few_values(spark):
    """With a value that stands out, the values of its bucket are all that is counted."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    kept = pruned_counts(df, ["v"])
    assert kept.where("v is not null").select("v").distinct().count() < 500
    assert pruned_modes(df, ["v"]).first().mode_v == column_profile(df, ["v"]).first().mode_v == -1
