"""The layers end to end: CSV -> bronze -> silver -> gold, each after the one before."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardmart.functions.calendar import DEFAULT_END, DEFAULT_START, calendar
from wardmart.operators.joins import ROWS_PER_SALT, measured_hot_keys
from wardmart.operators.quality import (
    fk_orphans, pk_violations, require_no_nulls, require_none,
)
from wardmart.operators.rejects import REJECTED, Account, rejects
from wardmart.plans import gold
from wardmart.plans.silver import CLEANERS, CONVERTED
from wardmart.schemas import RAW, conform, gold_tables
from wardmart.sources import files, published
from wardmart.sources.infer import inferred_types, typed
from wardmart.sources.published import Buckets
from wardmart.sources.shared import shared_folder
from wardmart.sources.targets import Target, load

log = logging.getLogger(__name__)

# Part of what a table is made from; to be raised when cleaners or schemas change.
RECIPE = "1"
# What the fact's joins meet on: silver tables are bucketed by these columns.
JOINED_ON = {
    "appointments": ("appointment_id",),
    "treatments": ("appointment_id",),
    "billing": ("patient_id", "treatment_id"),
}


@dataclass(frozen=True)
class Settings:
    """Folders may be on any file system the executors share."""

    input_root: str
    bronze_root: str
    silver_root: str
    target: Target
    # Where the fact is written before it is checked; None takes a folder below the one
    # the cluster names in spark.checkpoint.dir. Each run writes a copy of its own.
    staging_root: str | None = None
    # The date the run counts as today; None takes the clock's date.
    as_of: dt.date | str | None = None
    calendar_start: dt.date | str = DEFAULT_START
    calendar_end: dt.date | str = DEFAULT_END
    # "int" only where all business numbers are below 2,147,483,648: others become null.
    id_type: str = "bigint"
    load_mode: str = "insert_if_absent"
    # Keys with this many rows on the right side of a fact join are spread.
    hot_key_rows: int = ROWS_PER_SALT
    # More tables to ingest besides the registered ones; their types are inferred.
    extra_tables: tuple[str, ...] = field(default=())
    # Most values of one table that a layer's casts may lose; None allows any number. A table
    # beyond it is not published, and its last copy stays.
    max_rejected: int | None = None
    # Files that silver's join tables are bucketed into; None writes them unbucketed. About
    # a gigabyte a bucket serves large inputs.
    buckets: int | None = None
    # Leave tables alone whose inputs have not changed since they were published.
    resume: bool = False
    # Tables of a layer that are worked on at a time. Their jobs share the executors fairly
    # if the session was started with spark.scheduler.mode=FAIR.
    at_a_time: int = 4


class IngestError(RuntimeError):
    """Some tables could not be ingested; the others were."""

    def __init__(self, failures: Mapping[str, Exception]):
        self.failures = dict(failures)
        super().__init__("; ".join(f"{t}: {e}" for t, e in failures.items()))


def _table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _staging(spark: SparkSession, settings: Settings) -> str:
    if settings.staging_root is not None:
        return settings.staging_root
    mark = hashlib.sha256(settings.silver_root.encode()).hexdigest()[:16]
    return f"{shared_folder(spark)}/wardmart-staging-{mark}"


def _side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], None]],
                  at_a_time: int) -> dict[str, Exception]:
    """Runs jobs from threads, each with its own scheduler pool and job tag. One that fails
    does not stop the others; returns the failures in the order of ``jobs``."""
    def run(name: str) -> Exception | None:
        context = spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(f"wardmart-{name}")
        try:
            jobs[name]()
        except Exception as e:
            return e
        finally:
            context.removeJobTag(f"wardmart-{name}")
            context.setLocalProperty("spark.scheduler.pool", None)
        return None

    with ThreadPoolExecutor(max(1, at_a_time)) as pool:
        found = [(name, pool.submit(inheritable_thread_target(spark)(run), name)) for name in jobs]
        return {name: f.result() for name, f in found if f.result() is not None}


def _is_current(spark: SparkSession, settings: Settings, path: str, made_from: str) -> bool:
    """Whether a resumed run may leave the table at ``path`` as it is."""
    copy = published.current(spark, path) if settings.resume else None
    return copy is not None and copy.made_from == made_from


def _made_from(*parts: object) -> str:
    return hashlib.sha256("|".join(map(str, (RECIPE, *parts))).encode()).hexdigest()


def _ingest_table(spark: SparkSession, settings: Settings, name: str) -> None:
    source, path = _table(settings.input_root, f"{name}.csv"), _table(settings.bronze_root, name)
    schema = RAW.get(name)
    made_from = _made_from(published.fingerprint(spark, [source]), schema and schema.simpleString())
    if _is_current(spark, settings, path, made_from):
        log.info("%s is current", name)
        return
    if schema is None:
        # Parsed once, as text; the types come from what was stored.
        text = published.opened(spark, published.publish(
            spark.read.option("header", True).csv(source), f"{path}/_text", made_from))
        types = inferred_types(text)
        published.publish(typed(text, types), path, made_from)
        log.info("ingested %s as %s", name, types)
        return
    account = Account(name, [f.name for f in schema if not isinstance(f.dataType, T.StringType)])
    rows = account.watch(files.read_csv(spark, source, schema, REJECTED))
    published.publish(rows, path, made_from,
                      check=lambda: account.require_at_most(settings.max_rejected))
    log.info("ingested %s: %d rows, rejected values %s", name, account.rows, account.rejected)


def ingest(spark: SparkSession, settings: Settings) -> None:
    """CSV to Parquet per table, some tables at a time. One bad table does not stop the
    others and keeps its last copy, but the run fails in the end, naming every table that
    failed. Fields that are no value of their column's type are counted and kept."""
    jobs = {name: lambda n=name: _ingest_table(spark, settings, n)
            for name in [*RAW, *settings.extra_tables]}
    failures = _side_by_side(spark, jobs, settings.at_a_time)
    for name, e in failures.items():
        log.error("could not ingest %s: %s", name, e)
    if failures:
        raise IngestError(failures)


def _buckets(spark: SparkSession, settings: Settings, name: str) -> Buckets | None:
    """How a silver table is bucketed: not at all if a key is hot, as all its rows would be one
    bucket. The fact's join spreads such keys instead."""
    if settings.buckets is None or name not in JOINED_ON:
        return None
    keys = files.read_parquet(spark, _table(settings.bronze_root, name)).select(*JOINED_ON[name])
    least = settings.hot_key_rows
    if measured_hot_keys(keys, JOINED_ON[name], least, least) is not None:
        log.warning("%s has hot keys and is not bucketed", name)
        return None
    return Buckets(JOINED_ON[name], settings.buckets)


def _clean_table(spark: SparkSession, settings: Settings, name: str) -> None:
    source, path = _table(settings.bronze_root, name), _table(settings.silver_root, name)
    raw = published.current(spark, source)
    buckets = _buckets(spark, settings, name)
    today = settings.as_of or dt.date.today()
    made_of = raw.path if raw else published.fingerprint(spark, [source])
    made_from = _made_from(made_of, today, settings.id_type, buckets)
    if _is_current(spark, settings, path, made_from):
        log.info("%s is current", name)
        return
    account = Account(name, CONVERTED[name])
    rows = CLEANERS[name](files.read_parquet(spark, source).drop(REJECTED), settings.as_of,
                          settings.id_type, REJECTED)
    published.publish(account.watch(rows), path, made_from, buckets,
                      check=lambda: account.require_at_most(settings.max_rejected))
    log.info("cleaned %s: %d rows, rejected values %s", name, account.rows, account.rejected)


def build_silver(spark: SparkSession, settings: Settings) -> None:
    """Clean every table from bronze and publish it as the next copy, some tables at a time.
    All are tried; the first failure is raised in the end."""
    jobs = {name: lambda n=name: _clean_table(spark, settings, n) for name in CLEANERS}
    failures = _side_by_side(spark, jobs, settings.at_a_time)
    for name, e in failures.items():
        log.error("could not clean %s: %s", name, e)
    for e in failures.values():
        raise e


def read_rejects(spark: SparkSession, settings: Settings, layer: str, table: str) -> DataFrame:
    """The values of a bronze or silver table that casts lost: its row's key, the column, the raw text.

    The key of a bronze row is its business ID as delivered, that of a silver row the number,
    which is null where the ID itself was rejected.
    """
    root = {"bronze": settings.bronze_root, "silver": settings.silver_root}[layer]
    return rejects(files.read_parquet(spark, _table(root, table)), [RAW[table].names[0]])


def seed_calendar(spark: SparkSession, settings: Settings) -> DataFrame:
    """The compact calendar in silver, written once: a later call leaves it alone."""
    path = _table(settings.silver_root, "dim_date")
    files.write_parquet(
        calendar(spark, settings.calendar_start, settings.calendar_end, "compact"),
        path, "ignore")
    return files.read_parquet(spark, path)


def gold_dimensions(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The dimensions as plans over silver, in load order."""
    silver = {n: files.read_parquet(spark, _table(settings.silver_root, n))
              for n in ("doctors", "patients", "treatments")}
    return {
        "dim_doctors": gold.dim_doctors(silver["doctors"]),
        "dim_patients": gold.dim_patients(silver["patients"]),
        "dim_treatments": gold.dim_treatments(silver["treatments"]),
        "dim_date": calendar(spark, settings.calendar_start, settings.calendar_end),
    }


def gold_fact(spark: SparkSession, settings: Settings) -> DataFrame:
    """The fact as a plan over silver. Bucketed silver tables meet without a shuffle of
    appointments, treatments or bills; only what the first join returns is shuffled."""
    silver = {n: files.read_parquet(spark, _table(settings.silver_root, n)) for n in JOINED_ON}
    least = settings.hot_key_rows
    return gold.fact_appointments(
        silver["appointments"], silver["treatments"], silver["billing"],
        measured_hot_keys(silver["treatments"], "appointment_id", least, least),
        measured_hot_keys(silver["billing"], ["patient_id", "treatment_id"], least, least))


def _staged_fact(spark: SparkSession, settings: Settings, schema: T.StructType) -> DataFrame:
    """The fact, written once; each run reads the copy it made itself."""
    path = _table(_staging(spark, settings), "fact_appointments")
    inputs = [published.current(spark, _table(settings.silver_root, n)) for n in JOINED_ON]
    made_from = _made_from(*[c and c.path for c in inputs], schema.simpleString())
    if _is_current(spark, settings, path, made_from):
        return files.read_parquet(spark, path)
    fact = conform(gold_fact(spark, settings), schema)
    return published.opened(spark, published.publish(fact, path, made_from, keep=4))


def build_gold(spark: SparkSession, settings: Settings) -> None:
    """Check every table, then load it: dimensions first, so the fact's keys resolve.

    Nothing reaches the target unless all tables pass. The fact is staged first, so its
    joins run once however often it is read; the dimensions are plain columns of silver.
    """
    tables = gold_tables(settings.id_type)
    frames = {name: conform(df, tables[name].schema)
              for name, df in gold_dimensions(spark, settings).items()}
    frames["fact_appointments"] = _staged_fact(spark, settings, tables["fact_appointments"].schema)

    for name, table in tables.items():
        require_none(pk_violations(frames[name], table.key), f"primary key of {name}")
        if table.not_null:
            require_no_nulls(frames[name], table.not_null, f"not null in {name}")
        if table.references:
            dims = {fk: (frames[dim], key) for fk, (dim, key) in table.references.items()}
            require_none(fk_orphans(frames[name], dims), f"foreign keys of {name}")

    for name, table in tables.items():
        load(frames[name], settings.target, name, table.key, settings.load_mode,
             unique=True)
        log.info("loaded %s", name)


def run_medallion(spark: SparkSession, settings: Settings) -> None:
    """All layers in order; an exception in one keeps the next from starting."""
    ingest(spark, settings)
    build_silver(spark, settings)
    seed_calendar(spark, settings)
    build_gold(spark, settings)


def read_gold(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """A loaded gold table, also registered as a temporary view of its name."""
    df = settings.target.read(spark, table)
    if df is None:
        raise ValueError(f"{table} has not been loaded")
    df.createOrReplaceTempView(table)
    return df
