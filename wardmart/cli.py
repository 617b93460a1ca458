"""Command line for ``spark-submit``: one layer or all of them."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from wardmart.functions.calendar import DEFAULT_END, DEFAULT_START
from wardmart.plans.medallion import (
    Settings, build_gold, build_silver, ingest, run_medallion, seed_calendar,
)
from wardmart.schemas import KEY_TYPES
from wardmart.sources.jdbc import JdbcConnection
from wardmart.sources.targets import LOAD_MODES, JdbcTarget, ParquetTarget

STAGES = {
    "ingest": ingest,
    "silver": build_silver,
    "calendar": seed_calendar,
    "gold": build_gold,
    "all": run_medallion,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wardmart", description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--input", required=True, help="folder of the CSV tables")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    gold = p.add_mutually_exclusive_group(required=True)
    gold.add_argument("--gold", help="folder of the gold tables")
    gold.add_argument("--jdbc-url", help="database of the gold tables; user and password "
                      "come from WARDMART_JDBC_USER and WARDMART_JDBC_PASSWORD")
    p.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    p.add_argument("--staging")
    p.add_argument("--as-of", help="date that counts as today, default the clock's")
    p.add_argument("--calendar-start", default=str(DEFAULT_START))
    p.add_argument("--calendar-end", default=str(DEFAULT_END))
    p.add_argument("--id-type", choices=KEY_TYPES, default="bigint")
    p.add_argument("--load-mode", choices=LOAD_MODES, default="insert_if_absent")
    p.add_argument("--extra-table", action="append", default=[],
                   help="another CSV table to ingest, its types inferred")
    p.add_argument("--max-rejected", type=int, help="most values of a table that casts may lose")
    p.add_argument("--buckets", type=int, help="files that silver's join tables are bucketed into")
    p.add_argument("--resume", action="store_true",
                   help="leave tables alone whose inputs have not changed")
    return p


def settings_from(args: argparse.Namespace, environ: Mapping[str, str]) -> Settings:
    if args.gold:
        target = ParquetTarget(args.gold)
    else:
        target = JdbcTarget(JdbcConnection(
            args.jdbc_url, args.jdbc_driver, environ.get("WARDMART_JDBC_USER"),
            environ.get("WARDMART_JDBC_PASSWORD")))
    return Settings(
        input_root=args.input, bronze_root=args.bronze, silver_root=args.silver,
        target=target, staging_root=args.staging, as_of=args.as_of,
        calendar_start=args.calendar_start, calendar_end=args.calendar_end,
        id_type=args.id_type, load_mode=args.load_mode,
        extra_tables=tuple(args.extra_table), max_rejected=args.max_rejected,
        buckets=args.buckets, resume=args.resume)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"wardmart-{args.stage}").getOrCreate()
    STAGES[args.stage](spark, settings_from(args, os.environ))
