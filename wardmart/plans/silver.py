"""The five cleaners: raw table in, typed, deduplicated and filled table out.

Each result is one lazy plan. The statistics used for filling are subqueries of it
(``Profile``), not driver round trips. A cleaner keeps every other column of its input.
With ``rejected``, a last column of that name keeps the values that its casts lose.
``profiled`` makes the statistics; ``operators.states`` has one that adds up over deliveries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.functions.expressions import (
    DEFAULT_BRANCH, UNKNOWN, address_region, age_in_years, as_date, as_real, date_key,
    event_timestamp, full_name, run_date, standard_ids, title_clean,
)
from wardmart.operators.impute import deduplicate, drop_empty, fill, fill_constants
from wardmart.operators.profile import Profile
from wardmart.operators.rejects import convert

AsOf = dt.date | str | None
Profiled = Callable[..., Profile]


def clean_doctors(raw: DataFrame, as_of: AsOf = None, id_type: str = "bigint",
                  rejected: str | None = None, profiled: Profiled = Profile) -> DataFrame:
    """Copies are judged on the raw text: ``Smith`` and ``smith `` stay two rows."""
    rows = drop_empty(deduplicate(raw), ["doctor_id", "first_name", "last_name"])
    rows = rows.withColumns({c: title_clean(c) for c in (
        "first_name", "last_name", "specialization", "hospital_branch")})
    profile = profiled(rows, ["specialization"], means=["years_experience"])
    rows = fill_constants(rows, {
        "first_name": UNKNOWN, "last_name": UNKNOWN, "phone_number": UNKNOWN,
        "hospital_branch": DEFAULT_BRANCH})
    rows = fill(rows, {
        "specialization": profile.mode("specialization", UNKNOWN),
        "years_experience": profile.whole_mean("years_experience")})
    rows = rows.withColumn("full_name", full_name("first_name", "last_name"))
    return convert(rows, standard_ids("doctor_id", id_type=id_type), into=rejected)


def clean_patients(raw: DataFrame, as_of: AsOf = None, id_type: str = "bigint",
                   rejected: str | None = None, profiled: Profiled = Profile) -> DataFrame:
    """The most common values are taken before copies are removed.

    Age follows the birth date as delivered, so a missing one leaves age null although
    the date itself is filled with January 1st of the most common birth year.
    """
    typed = raw.withColumns({
        "date_of_birth": as_date("date_of_birth"),
        "registration_date": as_date("registration_date")})
    profile = profiled(
        typed.select("gender", "insurance_provider",
                     F.year("date_of_birth").alias("birth_year")),
        ["gender", "insurance_provider", "birth_year"])
    rows = drop_empty(deduplicate(typed), ["patient_id", "first_name", "last_name"])
    rows = rows.withColumns({
        "birth_date_year": F.year("date_of_birth"),
        "address_region": address_region("address")})
    rows = fill_constants(rows, {"first_name": UNKNOWN, "last_name": UNKNOWN})
    rows = fill(rows, {
        "gender": profile.mode("gender", UNKNOWN),
        "insurance_provider": profile.mode("insurance_provider", UNKNOWN),
        "date_of_birth": F.make_date(profile.mode("birth_year"), F.lit(1), F.lit(1)),
        "registration_date": run_date(as_of)})
    rows = rows.withColumns({
        "age": age_in_years("birth_date_year", as_of),
        "full_name": full_name(F.initcap("first_name"), F.initcap("last_name"))})
    return convert(rows, standard_ids("patient_id", id_type=id_type), into=rejected)


def clean_appointments(raw: DataFrame, as_of: AsOf = None, id_type: str = "bigint",
                       rejected: str | None = None, profiled: Profiled = Profile) -> DataFrame:
    """``date_id`` and the time stamp follow the date as delivered and stay null without
    one; only ``appointment_date`` itself is filled."""
    rows = drop_empty(deduplicate(raw), ["appointment_id", "patient_id", "doctor_id"])
    profile = profiled(rows, ["reason_for_visit", "status"])
    day = as_date("appointment_date")
    rows = convert(rows, {
        "appointment_date": day,
        "appointment_timestamp": event_timestamp("appointment_date", "appointment_time"),
        **standard_ids("appointment_id", "patient_id", "doctor_id", id_type=id_type)},
        # Without a date there is no time stamp to lose.
        raw={"appointment_timestamp": F.when(day.isNotNull(), F.col("appointment_time"))}, into=rejected)
    rows = rows.withColumn("date_id", date_key("appointment_date"))
    return fill(rows, {
        "appointment_date": run_date(as_of),
        "reason_for_visit": profile.mode("reason_for_visit", UNKNOWN),
        "status": profile.mode("status", UNKNOWN)})


def clean_billing(raw: DataFrame, as_of: AsOf = None, id_type: str = "bigint",
                  rejected: str | None = None, profiled: Profiled = Profile) -> DataFrame:
    rows = drop_empty(deduplicate(raw), ["bill_id", "patient_id", "amount"])
    profile = profiled(rows, ["payment_method", "payment_status"])
    rows = convert(rows, {
        "bill_date": as_date("bill_date"),
        "amount": as_real("amount"),
        **standard_ids("bill_id", "patient_id", "treatment_id", id_type=id_type)}, into=rejected)
    return fill(rows, {
        "bill_date": run_date(as_of),
        "payment_method": profile.mode("payment_method", UNKNOWN),
        "payment_status": profile.mode("payment_status", UNKNOWN)})


def clean_treatments(raw: DataFrame, as_of: AsOf = None, id_type: str = "bigint",
                     rejected: str | None = None, profiled: Profiled = Profile) -> DataFrame:
    """A missing cost becomes the most common cost; it stays null when there is none."""
    rows = drop_empty(deduplicate(raw), ["treatment_id", "treatment_type"])
    rows = convert(rows, {
        "treatment_date": as_date("treatment_date"),
        "cost": as_real("cost"),
        **standard_ids("treatment_id", "appointment_id", id_type=id_type)}, into=rejected)
    profile = profiled(rows, ["treatment_type", "cost"])
    return fill(rows, {
        "treatment_date": run_date(as_of),
        "treatment_type": profile.mode("treatment_type", UNKNOWN),
        "cost": profile.mode("cost")})


# The columns whose values a cleaner's casts may lose.
CONVERTED = {
    "doctors": ("doctor_id",),
    "patients": ("patient_id",),
    "appointments": (
        "appointment_id", "patient_id", "doctor_id", "appointment_date", "appointment_timestamp"),
    "billing": ("bill_id", "patient_id", "treatment_id", "bill_date", "amount"),
    "treatments": ("treatment_id", "appointment_id", "treatment_date", "cost"),
}

CLEANERS = {
    "doctors": clean_doctors,
    "patients": clean_patients,
    "appointments": clean_appointments,
    "billing": clean_billing,
    "treatments": clean_treatments,
}
