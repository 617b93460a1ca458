"""Queries on whole jobs: the cleaners, the gold tables, and all layers in a row."""

from __future__ import annotations

from wardmart.functions.calendar import calendar
from wardmart.operators.rejects import REJECTED, rejects
from wardmart.plans import gold, silver
from wardmart.plans.medallion import JOINED_ON, Settings, read_gold, run_medallion
from wardmart.plans.trends import trend
from wardmart.sources import published
from wardmart.sources.targets import ParquetTarget
from workload import clinic
from workload.operators import AS_OF
from workload.scratch import scratch_dir

CALENDAR = ("1995-01-01", "2001-12-31")


def _raw(spark, sf_dir, name, holes=True):
    """Raw table ``name``; treatments and bills have one row per order."""
    make = {"doctors": clinic.doctors, "patients": clinic.patients,
            "appointments": clinic.appointments, "treatments": clinic.treatments}
    text = clinic.billing() if name == "billing" else make[name](holes)
    return clinic.rows(spark, sf_dir, text, name)


def _cleaned(spark, sf_dir, name):
    return silver.CLEANERS[name](_raw(spark, sf_dir, name), AS_OF)


def clean_doctors(spark, sf_dir):
    return _cleaned(spark, sf_dir, "doctors")


def clean_patients(spark, sf_dir):
    return _cleaned(spark, sf_dir, "patients")


def clean_appointments(spark, sf_dir):
    return _cleaned(spark, sf_dir, "appointments")


def clean_billing(spark, sf_dir):
    return silver.clean_billing(
        clinic.rows(spark, sf_dir, clinic.billing_lines(), "billing"), AS_OF)


def clean_treatments(spark, sf_dir):
    return silver.clean_treatments(
        clinic.rows(spark, sf_dir, clinic.treatment_lines(), "treatments"), AS_OF)


def dim_doctors(spark, sf_dir):
    return gold.ordered(
        gold.dim_doctors(_cleaned(spark, sf_dir, "doctors")), "dim_doctors")


def dim_patients(spark, sf_dir):
    return gold.ordered(
        gold.dim_patients(_cleaned(spark, sf_dir, "patients")), "dim_patients")


def dim_treatments(spark, sf_dir):
    return gold.ordered(
        gold.dim_treatments(_cleaned(spark, sf_dir, "treatments")), "dim_treatments")


def _fact(spark, sf_dir):
    return gold.fact_appointments(*[
        _cleaned(spark, sf_dir, n) for n in ("appointments", "treatments", "billing")])


def fact_appointments(spark, sf_dir):
    return gold.ordered(_fact(spark, sf_dir), "fact_appointments")


# Fewest buckets, and the bytes of the given tables for which there is one.
BUCKETS, BUCKET_BYTES = 8, 16 << 20


def _bucket_number(spark, sf_dir):
    """As many buckets as the orders and line items call for: each is one task."""
    given = sum(published.size(spark, f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem"))
    return max(BUCKETS, -(-given // BUCKET_BYTES))


def fact_bucketed(spark, sf_dir):
    """The fact from silver tables that are bucketed on what its joins meet on."""
    root, number = scratch_dir(spark), _bucket_number(spark, sf_dir)
    copies = [
        published.publish(_cleaned(spark, sf_dir, name), f"{root}/{name}",
                          buckets=published.Buckets(JOINED_ON[name], number))
        for name in ("appointments", "treatments", "billing")]
    return gold.fact_appointments(*[published.opened(spark, c) for c in copies])


def rejected_casts(spark, sf_dir):
    """What the cleaning of appointments loses in its casts."""
    cleaned = silver.clean_appointments(_raw(spark, sf_dir, "appointments"), AS_OF, rejected=REJECTED)
    return rejects(cleaned, ["appointment_id", "date_id"])


def clinic_trend_month(spark, sf_dir):
    return trend(_fact(spark, sf_dir), calendar(spark, *CALENDAR), "month")


def _medallion(spark, sf_dir):
    """Raw tables as CSV, then all layers through files. Each call is a run of its own: a table
    folder may have changed since the last one."""
    root = scratch_dir(spark)
    for name in silver.CLEANERS:
        _raw(spark, sf_dir, name, holes=False).write.option("header", True).csv(
            f"{root}/input/{name}.csv")
    settings = Settings(
        input_root=f"{root}/input", bronze_root=f"{root}/bronze",
        silver_root=f"{root}/silver",
        target=ParquetTarget(f"{root}/gold"), as_of=AS_OF,
        calendar_start=CALENDAR[0], calendar_end=CALENDAR[1])
    run_medallion(spark, settings)
    return settings


def _gold_table(name):
    def query(spark, sf_dir):
        read_gold(spark, _medallion(spark, sf_dir), name)
        return spark.sql(f"select * from {name}")
    return query


QUERIES = {
    "q_clean_doctors": clean_doctors,
    "q_clean_patients": clean_patients,
    "q_clean_appointments": clean_appointments,
    "q_clean_billing": clean_billing,
    "q_clean_treatments": clean_treatments,
    "q_dim_doctors": dim_doctors,
    "q_dim_patients": dim_patients,
    "q_dim_treatments": dim_treatments,
    "q_fact_appointments": fact_appointments,
    "q_fact_bucketed": fact_bucketed,
    "q_rejected_casts": rejected_casts,
    "q_clinic_trend_month": clinic_trend_month,
    "q_medallion_fact": _gold_table("fact_appointments"),
    "q_medallion_doctors": _gold_table("dim_doctors"),
    "q_medallion_patients": _gold_table("dim_patients"),
    "q_medallion_treatments": _gold_table("dim_treatments"),
    "q_medallion_date": _gold_table("dim_date"),
}
