"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. It
includes finding the tables and building the plan; ``run_only`` leaves these out. The result
goes to the ``noop`` sink, so all rows and columns are computed and none kept.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from wardmart.functions.calendar import calendar
from wardmart.functions.expressions import standardize_id
from wardmart.operators.impute import deduplicate
from wardmart.operators.profile import column_profile, most_common
from wardmart.plans.gold import fact_appointments
from wardmart.plans.medallion import JOINED_ON
from wardmart.sources import published
from workload import jobs, operators
from workload.scratch import scratch_dir


def _lines(spark: SparkSession, sf_dir: str):
    return operators.table(spark, sf_dir, "lineitem")


def _tenth_twice(spark: SparkSession, sf_dir: str):
    lines = _lines(spark, sf_dir)
    return deduplicate(lines.unionAll(lines.where("l_orderkey % 10 = 0")))


_SILVER: dict[str, dict[str, published.Copy]] = {}


def _silver(spark: SparkSession, sf_dir: str, bucketed: bool):
    """Cleaned tables that were stored before the clock starts; stored on the first call."""
    kind = "bucketed" if bucketed else "plain"
    if kind not in _SILVER:
        root = scratch_dir(spark)
        _SILVER[kind] = {
            name: published.publish(
                jobs._cleaned(spark, sf_dir, name), f"{root}/{name}",
                buckets=published.Buckets(columns, 8) if bucketed else None)
            for name, columns in JOINED_ON.items()}
    return [published.opened(spark, _SILVER[kind][name]) for name in JOINED_ON]


# Jobs that show what a mechanism saves; not part of the sum either.
MORE = {
    "fact_of_stored_silver": lambda spark, sf_dir: fact_appointments(*_silver(spark, sf_dir, False)),
    "fact_of_bucketed_silver": lambda spark, sf_dir: fact_appointments(*_silver(spark, sf_dir, True)),
    "q_profile_pruned": operators.QUERIES["q_profile_pruned"],
    "q_pk_bitmap": operators.QUERIES["q_pk_bitmap"],
}

# first of them. They are not part of the sum.
BASELINE = {
    "base_dedup": _tenth_twice,
    "base_mode": lambda spark, sf_dir: most_common(_lines(spark, sf_dir), "l_partkey"),
    "base_three_modes": lambda spark, sf_dir: column_profile(
        _lines(spark, sf_dir), ["l_returnflag", "l_linestatus", "l_linenumber"]),
    "base_standardize_id": lambda spark, sf_dir: operators.table(spark, sf_dir, "customer").select(
        standardize_id("c_name", "Customer#").alias("customer_id")),
    "base_calendar": lambda spark, sf_dir: calendar(spark, "2020-01-01", "2026-12-31"),
}

HEADLINE = (
    "q_calendar", "q_standardize_id", "q_event_timestamp", "q_mode", "q_value_counts",
    "q_profile", "q_dedup", "q_dedup_rows", "q_left_join_composite", "q_fact_star",
    "q_trend_month", "q_pk_violations", "q_fk_violations", "q_clean_doctors",
    "q_clean_patients", "q_clean_appointments", "q_clean_billing", "q_clean_treatments",
    "q_fact_appointments",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("wardmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wardmart-warehouse-"))
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    found = operators.QUERIES | jobs.QUERIES | BASELINE | MORE

    def once(name: str) -> tuple[float, float]:
        """Seconds for the whole query, and for running its finished plan alone."""
        start = time.perf_counter()
        df = found[name](spark, sf_dir)
        built = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        end = time.perf_counter()
        return end - start, end - built

    whole, run_only = {}, {}
    for name in (*HEADLINE, *BASELINE, *MORE):
        once(name)
        timed = [once(name) for _ in range(runs)]
        whole[name] = round(statistics.median(t[0] for t in timed), 3)
        run_only[name] = round(statistics.median(t[1] for t in timed), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of warm median query times", "value": round(sum(whole[n] for n in HEADLINE), 3),
        "unit": "sec", "queries": {n: whole[n] for n in HEADLINE}, "baseline_jobs": {n: whole[n] for n in BASELINE},
        "more_jobs": {n: whole[n] for n in MORE},
        "run_only": run_only,
        "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
