"""Column contracts of the raw and gold tables, with their keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _I, _D, _DATE = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns])


# Phone numbers and clock times are text: neither is a quantity, a missing phone number
# is filled with a word, and inference would turn "8:00:00" into a time stamp of today.
RAW: dict[str, T.StructType] = {
    "patients": _struct(
        ("patient_id", _S), ("first_name", _S), ("last_name", _S), ("gender", _S),
        ("date_of_birth", _DATE), ("contact_number", _S), ("address", _S),
        ("registration_date", _DATE), ("insurance_provider", _S),
        ("insurance_number", _S), ("email", _S)),
    "doctors": _struct(
        ("doctor_id", _S), ("first_name", _S), ("last_name", _S), ("specialization", _S),
        ("phone_number", _S), ("years_experience", _I), ("hospital_branch", _S),
        ("email", _S)),
    "appointments": _struct(
        ("appointment_id", _S), ("patient_id", _S), ("doctor_id", _S),
        ("appointment_date", _DATE), ("appointment_time", _S),
        ("reason_for_visit", _S), ("status", _S)),
    "treatments": _struct(
        ("treatment_id", _S), ("appointment_id", _S), ("treatment_type", _S),
        ("description", _S), ("cost", _D), ("treatment_date", _DATE)),
    "billing": _struct(
        ("bill_id", _S), ("patient_id", _S), ("treatment_id", _S), ("bill_date", _DATE),
        ("amount", _D), ("payment_method", _S), ("payment_status", _S)),
}

# Key types: "int" as in the published warehouse schema; "bigint", the default, also holds
# numbers above 2,147,483,647 (a cast to int would turn those keys into nulls).
KEY_TYPES: dict[str, T.DataType] = {"int": T.IntegerType(), "bigint": T.LongType()}


@dataclass(frozen=True)
class GoldTable:
    name: str
    key: str
    schema: T.StructType
    # foreign key column -> (dimension, its key column)
    references: dict[str, tuple[str, str]]
    not_null: tuple[str, ...] = ()


def gold_tables(id_type: str = "bigint") -> dict[str, GoldTable]:
    """Gold tables in load order: dimensions first, the fact last."""
    key = KEY_TYPES[id_type]
    text, date_parts = _S, _I
    calendar = _struct(
        ("date_id", _I), ("full_date", _DATE), ("year", date_parts),
        ("quarter", date_parts), ("month_number", date_parts), ("month_name", text),
        ("day_of_week", date_parts), ("day_name", text), ("day_of_month", date_parts),
        ("week_of_year", date_parts), ("is_weekend", T.BooleanType()))
    tables = [
        GoldTable("dim_doctors", "doctor_id", _struct(
            ("doctor_id", key), ("full_name", text), ("specialization", text),
            ("years_experience", _I), ("hospital_branch", text)), {}),
        GoldTable("dim_patients", "patient_id", _struct(
            ("patient_id", key), ("full_name", text), ("gender", text), ("age", _I),
            ("address_region", text), ("insurance_provider", text)), {}),
        GoldTable("dim_treatments", "treatment_id", _struct(
            ("treatment_id", key), ("treatment_type", text), ("description", text),
            ("cost", T.FloatType())), {}),
        GoldTable("dim_date", "date_id", calendar, {},
                  not_null=tuple(calendar.names[1:])),
        GoldTable("fact_appointments", "appointment_id", _struct(
            ("appointment_id", key), ("patient_id", key), ("doctor_id", key),
            ("treatment_id", key), ("date_id", _I),
            ("appointment_timestamp", T.TimestampType()), ("status", text),
            ("amount", T.FloatType()), ("reason_for_visit", text)),
            {"patient_id": ("dim_patients", "patient_id"),
             "doctor_id": ("dim_doctors", "doctor_id"),
             "treatment_id": ("dim_treatments", "treatment_id"),
             "date_id": ("dim_date", "date_id")}),
    ]
    return {t.name: t for t in tables}


def _exact(name: str, old: T.DataType, new: T.DataType):
    """The column as ``new``; a value that does not fit is an error in either ANSI mode."""
    if old == new:
        return F.col(name)
    cast = F.col(name).try_cast(new)
    lost = F.concat(F.lit(f"{name} does not fit into {new.simpleString()}: "), F.col(name).cast("string"))
    return F.when(F.col(name).isNotNull() & cast.isNull(), F.raise_error(lost)).otherwise(cast).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; a missing one is an error."""
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the result: {missing}")
    return df.select(*[_exact(f.name, df.schema[f.name].dataType, f.dataType) for f in schema])
