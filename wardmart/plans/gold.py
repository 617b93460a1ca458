"""Star schema: three dimensions and the appointments fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.operators.joins import left_join

# The measure each table is ordered by when it is shown as an ordered result.
ORDER_BY = {
    "fact_appointments": ("amount", "appointment_id"),
    "dim_doctors": ("years_experience", "doctor_id"),
    "dim_patients": ("age", "patient_id"),
    "dim_treatments": ("cost", "treatment_id"),
}


def dim_doctors(doctors: DataFrame) -> DataFrame:
    return doctors.select(
        "doctor_id", "full_name", "specialization", "years_experience", "hospital_branch")


def dim_patients(patients: DataFrame) -> DataFrame:
    return patients.select(
        "patient_id", "full_name", "gender", "age", "address_region", "insurance_provider")


def dim_treatments(treatments: DataFrame) -> DataFrame:
    return treatments.select("treatment_id", "treatment_type", "description", "cost")


def fact_appointments(appointments: DataFrame, treatments: DataFrame, billing: DataFrame,
                      hot_appointments: DataFrame | None = None,
                      hot_bills: DataFrame | None = None) -> DataFrame:
    """One row per appointment, treatment and bill of the same patient.

    An appointment without treatment, or a treatment without a bill, keeps its row with
    nulls. The second join needs the first one's ``treatment_id``, so the order is given.
    Only the columns the result needs are shuffled. ``hot_*`` are the measured hot keys
    of treatments by appointment and of bills by patient and treatment.
    """
    treated = left_join(
        appointments.select(
            "appointment_id", "patient_id", "doctor_id", "date_id",
            "appointment_timestamp", "status", "reason_for_visit"),
        treatments.select("appointment_id", "treatment_id"),
        "appointment_id", hot_appointments)
    billed = left_join(
        treated, billing.select("patient_id", "treatment_id", "amount", "bill_id"),
        ["patient_id", "treatment_id"], hot_bills, spread_by=["bill_id"])
    return billed.select(
        "appointment_id", "patient_id", "doctor_id", "treatment_id", "date_id",
        "appointment_timestamp", "status", "amount", "reason_for_visit")


def ordered(df: DataFrame, table: str) -> DataFrame:
    """The table as an ordered result: by its measure, nulls first, ties by key.

    For reading only; a load does not sort, since a stored table has no row order. The
    key in the sort also lets a run of equal measures span several partitions.
    """
    measure, key = ORDER_BY[table]
    return df.orderBy(F.asc_nulls_first(measure), F.asc(key))
