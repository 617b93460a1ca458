"""Jobs over raw tables: copies in one pass, whole runs, buckets that grow with the input."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from collections import Counter

import pytest

from workload import clinic, jobs

TEXTS = {
    "doctors": clinic.doctors(), "patients": clinic.patients(), "appointments": clinic.appointments(),
    "treatments": clinic.treatments(), "billing": clinic.billing()}
LINES = {"treatments": clinic.treatment_lines(), "billing": clinic.billing_lines()}


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Small tables with nulls and with keys that repeat."""
    root, day = str(tmp_path_factory.mktemp("given")), dt.datetime(1997, 5, 6)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (1, "ASIA"), (2, "EUROPE"), (3, None)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int",
                   [(i, f"NATION {i}", i % 4) for i in range(25)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"Supplier {i}", i % 25, 50.0 - i if i % 7 else None) for i in range(60)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"Customer {i}", i % 25, 100.0 * i - 950, None if i % 9 == 0 else "BUILDING")
                      for i in range(80)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp, o_orderpriority string",
                   [(i, i % 80, "FOP"[i % 3], 700.0 * i, day + dt.timedelta(days=i),
                     ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", None)[i % 5]) for i in range(300)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(i % 290, i % 40, i % 60, float(i % 50), 3.25 * i, "ANR"[i % 3], "FO"[i % 2], day)
                      for i in range(900)] * 2),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name, text", [*TEXTS.items(), *LINES.items()])
def test_raw_rows_are_made_once(spark, given, name, text):
    """The copies come from the same pass as the rows, and are those of the shared SQL."""
    df = clinic.rows(spark, given, text, name)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    assert "Union" not in out.getvalue()
    for table in clinic.names_of(text):
        spark.read.parquet(f"{given}/{table}.parquet").createOrReplaceTempView(f"given_{table}")
    shared = spark.sql(text.format(**{n: f"given_{n}" for n in clinic.names_of(text)})).to(df.schema)
    assert Counter(df.collect()) == Counter(shared.collect())


@pytest.mark.parametrize("table", ["fact_appointments", "dim_doctors", "dim_date"])
def test_each_gold_query_is_a_run(spark, monkeypatch, table):
    """No query reads what another one left: each runs all layers, over the tables as they are."""
    runs = []
    monkeypatch.setattr(jobs, "_raw", lambda s, *a, **k: s.range(1))
    monkeypatch.setattr(jobs, "run_medallion", lambda s, settings: runs.append(settings))
    monkeypatch.setattr(jobs, "read_gold", lambda s, settings, name: s.range(1).createOrReplaceTempView(name))
    for _ in range(2):
        jobs.QUERIES[f"q_medallion_{table.split('_')[-1] if table != 'fact_appointments' else 'fact'}"](spark, "given")
    assert len({s.input_root for s in runs}) == 2


def test_buckets_follow_the_input(spark, given, monkeypatch):
    used = []
    publish = jobs.published.publish
    monkeypatch.setattr(jobs.published, "publish", lambda *a, **k: used.append(k["buckets"].number) or publish(*a, **k))
    few = Counter(jobs.fact_bucketed(spark, given).collect())
    assert used == [jobs.BUCKETS] * 3
    monkeypatch.setattr(jobs, "BUCKET_BYTES", 500, raising=False)
    assert Counter(jobs.fact_bucketed(spark, given).collect()) == few
    assert len(set(used[3:])) == 1 and used[3] > 20
