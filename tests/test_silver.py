"""The cleaners on rows that the given tables lack."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardmart.plans import silver
from wardmart.schemas import RAW

AS_OF = "2024-01-01"
DAY, TODAY = dt.date(2023, 8, 9), dt.date(2024, 1, 1)


def frame(spark, name, *records):
    names = RAW[name].names
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in records], RAW[name])


def by(df, key):
    return {r[key]: r for r in df.collect()}


def doctor(**change):
    return {"doctor_id": "D001", "first_name": "ann", "last_name": "lee",
            "specialization": "oncology", "phone_number": "1", "years_experience": 10,
            "hospital_branch": "west", "email": "e"} | change


def patient(**change):
    return {"patient_id": "P001", "first_name": "ann", "last_name": "lee", "gender": "F",
            "date_of_birth": dt.date(1991, 5, 6), "contact_number": "1",
            "address": "789 Pine Rd", "registration_date": DAY,
            "insurance_provider": "X", "insurance_number": "I", "email": "e"} | change


def appointment(**change):
    return {"appointment_id": "A001", "patient_id": "P001", "doctor_id": "D001",
            "appointment_date": DAY, "appointment_time": "8:00:00",
            "reason_for_visit": "Checkup", "status": "Scheduled"} | change


def treatment(**change):
    return {"treatment_id": "T001", "appointment_id": "A001", "treatment_type": "MRI",
            "description": "d", "cost": 10.5, "treatment_date": DAY} | change


def bill(**change):
    return {"bill_id": "B001", "patient_id": "P001", "treatment_id": "T001",
            "bill_date": DAY, "amount": 10.5, "payment_method": "Cash",
            "payment_status": "Paid"} | change


def test_doctors(spark):
    raw = frame(
        spark, "doctors",
        doctor(), doctor(),                                          # one copy goes
        doctor(doctor_id="D002", first_name="  mARY ann-lee ", last_name=None),
        doctor(doctor_id="D003", specialization=None, years_experience=None,
               phone_number=None, hospital_branch=None),
        doctor(doctor_id="D004", specialization="Pediatrics", years_experience=15),
        doctor(doctor_id=None, first_name=None, last_name=None),     # no key at all: goes
        doctor(doctor_id="DX", email="x"))
    found = by(silver.clean_doctors(raw, AS_OF), "doctor_id")
    assert set(found) == {1, 2, 3, 4, None}
    assert found[1].full_name == "Ann Lee"
    assert found[2].full_name == "Mary Ann-lee UNKNOWN"
    three = found[3]
    assert three.specialization == "Oncology" and three.years_experience == 11   # 45 / 4
    assert three.phone_number == "UNKNOWN" and three.hospital_branch == "Central Hospital"


def test_doctors_that_differ_in_case_stay_two(spark):
    raw = frame(spark, "doctors", doctor(last_name="Smith"), doctor(last_name="smith "))
    assert [r.last_name for r in silver.clean_doctors(raw).collect()] == ["Smith", "Smith"]


def test_doctors_without_any_value_to_fill_with(spark):
    raw = frame(spark, "doctors", doctor(specialization=None, years_experience=None))
    row = silver.clean_doctors(raw).first()
    assert (row.specialization, row.years_experience) == ("UNKNOWN", 0)


def test_patients(spark):
    raw = frame(
        spark, "patients",
        patient(),
        patient(patient_id="P002", first_name=None, gender=None, address="abc",
                insurance_provider=None),
        patient(patient_id="P003", date_of_birth=None, registration_date=None, address=None),
        patient(patient_id=None, first_name=None, last_name=None, gender="M"))
    found = by(silver.clean_patients(raw, AS_OF), "patient_id")
    assert set(found) == {1, 2, 3}
    assert found[1].age == 33 and found[1].address_region == "Pine"
    assert found[1].first_name == "ann" and found[1].full_name == "Ann Lee"
    assert found[2].full_name == "Unknown Lee" and found[2].first_name == "UNKNOWN"
    assert found[2].gender == "F" and found[2].insurance_provider == "X"
    assert found[2].address_region is None
    three = found[3]
    assert three.date_of_birth == dt.date(1991, 1, 1) and three.age is None
    assert three.birth_date_year is None and three.registration_date == TODAY


def test_patient_modes_count_copies(spark):
    """The most common values are taken before copies go: M twice beats F once."""
    raw = frame(spark, "patients",
                patient(patient_id="P001", gender="M"), patient(patient_id="P001", gender="M"),
                patient(patient_id="P002", gender="F"), patient(patient_id="P003", gender=None))
    assert by(silver.clean_patients(raw, AS_OF), "patient_id")[3].gender == "M"


def test_other_modes_do_not_count_copies(spark):
    raw = frame(spark, "billing",
                bill(bill_id="B1", payment_method="Z"), bill(bill_id="B1", payment_method="Z"),
                bill(bill_id="B2", payment_method="A"), bill(bill_id="B3", payment_method=None))
    assert by(silver.clean_billing(raw, AS_OF), "bill_id")[3].payment_method == "A"


def test_patients_without_birth_dates(spark):
    row = silver.clean_patients(
        frame(spark, "patients", patient(date_of_birth=None, gender=None)), AS_OF).first()
    assert row.date_of_birth is None and row.gender == "UNKNOWN"


def test_appointments(spark):
    raw = frame(
        spark, "appointments",
        appointment(),
        appointment(appointment_id="A002", doctor_id="DX", appointment_time="15:15:00"),
        appointment(appointment_id="A003", appointment_date=None, reason_for_visit=None,
                    status=None),
        appointment(appointment_id="A004", appointment_time="noon"),
        appointment(appointment_id=None, patient_id=None, doctor_id=None))
    found = by(silver.clean_appointments(raw, AS_OF), "appointment_id")
    assert set(found) == {1, 2, 3, 4}
    assert found[1].date_id == 20230809
    assert found[1].appointment_timestamp == dt.datetime(2023, 8, 9, 8)
    assert found[2].doctor_id is None
    three = found[3]
    assert three.appointment_date == TODAY and three.date_id is None
    assert three.appointment_timestamp is None
    assert (three.reason_for_visit, three.status) == ("Checkup", "Scheduled")
    assert found[4].appointment_timestamp is None


def test_billing(spark):
    raw = frame(spark, "billing",
                bill(), bill(bill_id="B002", bill_date=None, amount=None, payment_method=None,
                             payment_status=None),
                bill(bill_id=None, patient_id=None, amount=None))
    found = by(silver.clean_billing(raw, AS_OF), "bill_id")
    assert set(found) == {1, 2}
    two = found[2]
    assert two.bill_date == TODAY and two.amount is None
    assert (two.payment_method, two.payment_status) == ("Cash", "Paid")


def test_treatments(spark):
    raw = frame(spark, "treatments",
                treatment(), treatment(treatment_id="T002", cost=3.25),
                treatment(treatment_id="T003", cost=None, treatment_type=None,
                          treatment_date=None),
                treatment(treatment_id=None, treatment_type=None))
    found = by(silver.clean_treatments(raw, AS_OF), "treatment_id")
    assert set(found) == {1, 2, 3}
    assert found[3].cost == 3.25          # tie of 3.25 and 10.5: the lower one
    assert found[3].treatment_type == "MRI" and found[3].treatment_date == TODAY


def test_treatments_without_costs_keep_null(spark):
    raw = frame(spark, "treatments", treatment(cost=None, treatment_type=None))
    row = silver.clean_treatments(raw, AS_OF).first()
    assert row.cost is None and row.treatment_type == "UNKNOWN"


@pytest.mark.parametrize("name", sorted(silver.CLEANERS))
def test_empty_table(spark, name):
    assert silver.CLEANERS[name](spark.createDataFrame([], RAW[name]), AS_OF).count() == 0


@pytest.mark.parametrize("name, record", [
    ("doctors", doctor()), ("patients", patient()), ("appointments", appointment()),
    ("treatments", treatment()), ("billing", bill())])
def test_cleaning_twice_changes_nothing(spark, name, record):
    once = silver.CLEANERS[name](frame(spark, name, record), AS_OF)
    again = silver.CLEANERS[name](once.select(*RAW[name].names), AS_OF)
    assert again.select(*once.columns).collect() == once.collect()


def test_other_columns_pass_through(spark):
    raw = frame(spark, "billing", bill()).withColumn("note", F.lit("kept"))
    assert silver.clean_billing(raw, AS_OF).first().note == "kept"


def test_text_dates_are_typed(spark):
    raw = frame(spark, "billing", bill()).withColumn("bill_date", F.lit("garbage"))
    assert silver.clean_billing(raw, AS_OF).first().bill_date == TODAY
