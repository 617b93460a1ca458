"""All layers through files, on a handful of hand-written rows."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import replace

import pytest

from wardmart.operators.quality import IntegrityError
from wardmart.plans.medallion import (
    IngestError, Settings, _side_by_side, _staging, build_gold, build_silver, ingest, read_gold,
    read_rejects, run_medallion,
)
from wardmart.plans.silver import CLEANERS
from wardmart.sources import files, published
from wardmart.sources.targets import ParquetTarget

CSV = {
    "patients": """\
patient_id,first_name,last_name,gender,date_of_birth,contact_number,address,registration_date,insurance_provider,insurance_number,email
P001,zora,quill,F,1988-11-30,0017250044,12 Lantern Way,2021-02-14,Meadow,K-77,zq@example.org
P002,odo,finch,,1975-04-19,5550100200,7 Harbor Row,,Meadow,K-78,of@example.org
P002,odo,finch,,1975-04-19,5550100200,7 Harbor Row,,Meadow,K-78,of@example.org
""",
    "doctors": """\
doctor_id,first_name,last_name,specialization,phone_number,years_experience,hospital_branch,email
D001,ines,marlow,radiology,5550100300,9,hill house,im@example.org
""",
    "appointments": """\
appointment_id,patient_id,doctor_id,appointment_date,appointment_time,reason_for_visit,status
A001,P001,D001,2023-10-03,13:05:00,Vaccine,Planned
A002,P002,D001,2023-05-17,7:45:00,,Missed
A003,P002,,,7:45:00,Vaccine,Missed
""",
    "treatments": """\
treatment_id,appointment_id,treatment_type,description,cost,treatment_date
T001,A001,Scan,Short,120.25,2023-10-03
T002,A002,Scan,Short,310.5,2023-05-17
""",
    "billing": """\
bill_id,patient_id,treatment_id,bill_date,amount,payment_method,payment_status
B001,P001,T001,2023-10-03,120.25,Voucher,Open
""",
}


@pytest.fixture
def settings(tmp_path):
    source = tmp_path / "input"
    source.mkdir()
    for name, text in CSV.items():
        (source / f"{name}.csv").write_text(text)
    return Settings(
        input_root=str(source), bronze_root=str(tmp_path / "bronze"),
        silver_root=str(tmp_path / "silver"),
        target=ParquetTarget(str(tmp_path / "gold")), as_of="2024-01-01")


def change(settings, name, old, new):
    path = f"{settings.input_root}/{name}.csv"
    with open(path) as f:
        text = f.read()
    assert old in text
    with open(path, "w") as f:
        f.write(text.replace(old, new))


def fact(spark, settings):
    read_gold(spark, settings, "fact_appointments")
    return [tuple(r) for r in
            spark.sql("select * from fact_appointments order by appointment_id").collect()]


EXPECTED = [
    (1, 1, 1, 1, 20231003, dt.datetime(2023, 10, 3, 13, 5), "Planned",
     pytest.approx(120.25), "Vaccine"),
    (2, 2, 1, 2, 20230517, dt.datetime(2023, 5, 17, 7, 45), "Missed", None, "Vaccine"),
    (3, 2, None, None, None, None, "Missed", None, "Vaccine"),
]


def test_whole_run_and_rerun(spark, settings):
    for _ in range(2):
        run_medallion(spark, settings)
        assert fact(spark, settings) == EXPECTED
        patients = {r.patient_id: r for r in read_gold(spark, settings, "dim_patients").collect()}
        assert patients[1].full_name == "Zora Quill" and patients[1].age == 36
        assert patients[2].gender == "F" and patients[2].address_region == "Harbor"
        assert read_gold(spark, settings, "dim_doctors").first().hospital_branch == "Hill House"
        assert read_gold(spark, settings, "dim_treatments").count() == 2
        assert read_gold(spark, settings, "dim_date").count() == 2557
    silver = files.read_parquet(spark, f"{settings.silver_root}/patients")
    assert "0017250044" in {r.contact_number for r in silver.collect()}  # phones are text
    compact = files.read_parquet(spark, f"{settings.silver_root}/dim_date")
    assert len(compact.columns) == 6 and compact.count() == 2557


def test_staging_folder(spark, settings, tmp_path):
    shared = _staging(spark, settings)
    assert shared.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared == _staging(spark, settings)
    assert shared != _staging(spark, replace(settings, silver_root="elsewhere"))
    assert _staging(spark, replace(settings, staging_root="here")) == "here"


def test_hot_keys_change_nothing(spark, settings):
    run_medallion(spark, replace(settings, hot_key_rows=1))
    assert fact(spark, settings) == EXPECTED


def test_wide_keys(spark, settings):
    change(settings, "appointments", "A003", "A3000000000")
    wide = replace(settings, id_type="bigint")
    run_medallion(spark, wide)
    assert fact(spark, wide)[-1][0] == 3000000000


def test_later_rows_are_added(spark, settings):
    run_medallion(spark, settings)
    change(settings, "appointments", "A003,", "A004,P001,D001,2023-10-04,9:00:00,Vaccine,Done\nA003,")
    run_medallion(spark, settings)
    assert [r[0] for r in fact(spark, settings)] == [1, 2, 3, 4]


def test_replacing_load(spark, settings):
    run_medallion(spark, settings)
    change(settings, "appointments", "Planned", "Done")
    run_medallion(spark, settings)
    assert fact(spark, settings)[0][6] == "Planned"
    run_medallion(spark, replace(settings, load_mode="replace"))
    assert [r[6] for r in fact(spark, settings)] == ["Done", "Missed", "Missed"]


def test_one_bad_table_does_not_stop_the_others(spark, settings):
    broken = replace(settings, extra_tables=("absent",))
    with pytest.raises(IngestError) as e:
        ingest(spark, broken)
    assert set(e.value.failures) == {"absent"}
    assert files.read_parquet(spark, f"{settings.bronze_root}/treatments").count() == 2


def test_an_extra_table_is_inferred(spark, settings):
    with open(f"{settings.input_root}/rooms.csv", "w") as f:
        f.write("room,beds\nR1,2\n")
    ingest(spark, replace(settings, extra_tables=("rooms",)))
    rooms = files.read_parquet(spark, f"{settings.bronze_root}/rooms")
    assert dict(rooms.dtypes) == {"room": "string", "beds": "int"}


@pytest.mark.parametrize("name, old, new, message", [
    ("treatments", "T002,A002", "T002,A001", "primary key of fact_appointments"),
    ("appointments", "A002,P002", "A002,P009", "foreign keys of fact_appointments"),
    ("appointments", "2023-05-17", "2035-05-17", "foreign keys of fact_appointments"),
    ("doctors", "D001", "DX", "primary key of dim_doctors"),
])
def test_broken_rules_stop_the_load(spark, settings, name, old, new, message):
    change(settings, name, old, new)
    ingest(spark, settings)
    build_silver(spark, settings)
    with pytest.raises(IntegrityError, match=message):
        build_gold(spark, settings)
    with pytest.raises(ValueError, match="not been loaded"):
        read_gold(spark, settings, "dim_patients")


def test_rejected_values_are_kept(spark, settings):
    change(settings, "appointments", "2023-05-17,7:45:00", "17.05.2023,7:45:00")
    change(settings, "appointments", "13:05:00", "noon")
    change(settings, "billing", "120.25", "12o.25")
    run_medallion(spark, settings)
    bronze = [tuple(r) for r in read_rejects(spark, settings, "bronze", "appointments").collect()]
    assert bronze == [("A002", "appointment_date", "17.05.2023")]
    assert [tuple(r) for r in read_rejects(spark, settings, "bronze", "billing").collect()] == [("B001", "amount", "12o.25")]
    silver = [tuple(r) for r in read_rejects(spark, settings, "silver", "appointments").collect()]
    assert silver == [(1, "appointment_timestamp", "noon")]
    assert read_rejects(spark, settings, "silver", "doctors").count() == 0


def test_too_many_rejected_values_keep_the_last_copy(spark, settings):
    run_medallion(spark, replace(settings, max_rejected=0))
    change(settings, "billing", "120.25", "12o.25")
    change(settings, "treatments", "120.25", "130.25")
    with pytest.raises(IngestError) as e:
        ingest(spark, replace(settings, max_rejected=0))
    assert set(e.value.failures) == {"billing"} and "1 rejected values, 0 allowed" in str(e.value)
    held = files.read_parquet(spark, f"{settings.bronze_root}/billing").first()
    assert held.amount == 120.25  # the last good copy
    costs = {r.cost for r in files.read_parquet(spark, f"{settings.bronze_root}/treatments").collect()}
    assert 130.25 in costs  # the others went on
    ingest(spark, replace(settings, max_rejected=1))
    assert files.read_parquet(spark, f"{settings.bronze_root}/billing").first().amount is None


def copies(spark, root, names):
    return {n: published.current(spark, f"{root}/{n}").number for n in names}


def test_a_resumed_run_redoes_what_is_missing_or_changed(spark, settings, monkeypatch):
    resumed = replace(settings, resume=True, at_a_time=1)
    ingest(spark, resumed)
    names = list(CLEANERS)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        for name in names[3:]:
            m.setitem(CLEANERS, name, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            build_silver(spark, resumed)
    assert [published.current(spark, f"{settings.silver_root}/{n}") is None for n in names] == [False] * 3 + [True] * 2
    ingest(spark, resumed)
    build_silver(spark, resumed)
    assert set(copies(spark, settings.bronze_root, names).values()) == {1}
    assert set(copies(spark, settings.silver_root, names).values()) == {1}
    change(settings, "appointments", "Planned", "Done")
    run_medallion(spark, resumed)
    assert copies(spark, settings.silver_root, names) == {n: 2 if n == "appointments" else 1 for n in names}
    assert fact(spark, settings)[0][6] == "Done"
    build_silver(spark, replace(resumed, as_of="2025-01-01"))  # another date that counts as today
    assert copies(spark, settings.silver_root, names) == {n: 3 if n == "appointments" else 2 for n in names}


def test_buckets_change_nothing(spark, settings):
    run_medallion(spark, replace(settings, buckets=4))
    assert fact(spark, settings) == EXPECTED
    assert published.current(spark, f"{settings.silver_root}/billing").buckets.columns == ("patient_id", "treatment_id")


def test_tables_with_hot_keys_are_not_bucketed(spark, settings):
    run_medallion(spark, replace(settings, buckets=4, hot_key_rows=2))
    assert fact(spark, settings) == EXPECTED
    assert published.current(spark, f"{settings.silver_root}/treatments").buckets is not None
    change(settings, "treatments", "T002,A002", "T002,A001")
    ingest(spark, settings)
    build_silver(spark, replace(settings, buckets=4, hot_key_rows=2))
    assert published.current(spark, f"{settings.silver_root}/treatments").buckets is None
    assert published.current(spark, f"{settings.silver_root}/billing").buckets is not None


def test_tables_side_by_side_fail_in_order(spark, settings):
    """The same errors, in the same order, however many tables are worked on at a time."""
    broken = replace(settings, extra_tables=("absent", "missing"))
    found = []
    for at_a_time in (1, 4):
        with pytest.raises(IngestError) as e:
            ingest(spark, replace(broken, at_a_time=at_a_time))
        found.append(list(e.value.failures))
    assert found == [["absent", "missing"]] * 2


def test_jobs_run_side_by_side(spark):
    """Four jobs that each wait for the others can only end together."""
    together, seen = threading.Barrier(4, timeout=60), []

    def job():
        together.wait()
        assert spark.range(10).count() == 10
        seen.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))

    assert _side_by_side(spark, {f"t{i}": job for i in range(4)}, 4) == {}
    assert sorted(seen) == ["t0", "t1", "t2", "t3"]


def test_two_runs_read_their_own_facts(spark, settings, tmp_path):
    """Runs that share the staging folder do not see each other's rows."""
    run_medallion(spark, replace(settings, staging_root=str(tmp_path / "staging")))
    first = published.current(spark, str(tmp_path / "staging/fact_appointments"))
    run_medallion(spark, replace(settings, staging_root=str(tmp_path / "staging")))
    second = published.current(spark, str(tmp_path / "staging/fact_appointments"))
    assert first.path != second.path and published.opened(spark, first).count() == 3
