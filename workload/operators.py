"""Queries on single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.functions.calendar import calendar_for
from wardmart.functions.expressions import (
    UNKNOWN, address_region, age_in_years, as_date, as_real, cents, date_key,
    event_timestamp, full_name, money, run_date, standardize_id, title_clean,
)
from wardmart.operators.bitmaps import pk_violations_by_bitmap
from wardmart.operators.impute import (
    deduplicate, drop_empty, fill, fill_constants, not_null,
)
from wardmart.operators.joins import left_join, measured_hot_keys
from wardmart.operators.profile import (
    Profile, column_profile, most_common, pruned_modes, value_counts,
)
from wardmart.operators.quality import fk_orphans, null_counts, pk_violations
from wardmart.operators.rejects import REJECTED, Account, rejects
from wardmart.operators.states import Deliveries, profile_of_states
from wardmart.operators.upsert import absent_rows
from wardmart.plans.trends import trend
from wardmart.schemas import conform, gold_tables
from wardmart.sources import files, published
from wardmart.sources.infer import type_report
from wardmart.sources.targets import IndexedParquetTarget, ParquetTarget, load
from workload.scratch import scratch_dir

# The date these queries count as today.
AS_OF = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _holed_customers(spark, sf_dir):
    """Customers in which some values are missing."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") > 4, F.col("c_name")).alias("name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("nation"))


# Rows and columns

def project_rename(spark, sf_dir):
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_name", "s_nationkey")
        .withColumnRenamed("s_nationkey", "nation")
        .withColumns({"label": F.concat_ws("-", "s_name", "nation")}))


def filter_not_null(spark, sf_dir):
    return not_null(_holed_customers(spark, sf_dir), "segment")


def drop_all_null(spark, sf_dir):
    return drop_empty(_holed_customers(spark, sf_dir), ["name", "segment", "nation"])


def dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return deduplicate(lines)


def dedup_rows(spark, sf_dir):
    """All line items plus one more copy of the returned ones, all columns compared."""
    lines = table(spark, sf_dir, "lineitem")
    return deduplicate(lines.unionAll(lines.filter(F.col("l_returnflag") == "R")))


def conform_dim(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("cost"), F.col("p_name").alias("description"),
        F.col("p_type").alias("treatment_type"), F.col("p_partkey").alias("treatment_id"),
        "p_brand")
    return conform(parts, gold_tables()["dim_treatments"].schema)


# Expressions

def standardize_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", standardize_id("c_name", "Customer#").alias("customer_id"),
        standardize_id(F.concat("c_mktsegment", "c_custkey"), "BUILDING")
        .alias("segment_id"))


def initcap_trim(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" "), "p_type").alias("raw"))
    return words.select("p_partkey", title_clean("raw").alias("title"))


def full_names(spark, sf_dir):
    return _holed_customers(spark, sf_dir).select(
        "c_custkey", full_name("segment", "name").alias("full_name"))


def address_token(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", address_region("p_name").alias("second"),
        address_region("p_brand").alias("none"))


def cast_real(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        as_real("l_extendedprice").alias("price"),
        as_real("l_returnflag").alias("malformed"))


def date_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", date_key("o_orderdate").alias("date_id"),
        as_date(F.concat(F.col("o_orderdate").cast("date").cast("string"),
                         F.when(F.col("o_orderstatus") == "P", "x").otherwise("")))
        .alias("order_date"))


def age(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", age_in_years(F.year("o_orderdate"), AS_OF).alias("age"))


def event_timestamps(spark, sf_dir):
    ts = F.col("ts")
    parts = table(spark, sf_dir, "events").select(
        "event_id", ts.cast("date").alias("day"),
        F.when(F.col("event_type") != "error", F.date_format(ts, "H:mm:ss"))
        .otherwise("n/a").alias("clock"))
    return parts.select("event_id", event_timestamp("day", "clock").alias("at"))


# Joins

def left_join_single(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return left_join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), orders,
        "c_custkey", measured_hot_keys(orders, "c_custkey"))


def left_join_composite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return left_join(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"),
        returned, ["l_partkey", "l_suppkey"])


def left_join_hot_keys(spark, sf_dir):
    """Five event types hold all events; each is spread over salts."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    kinds = (
        events.groupBy("event_type").agg(F.count("*").alias("n_events"))
        .unionAll(events.groupBy("event_type").agg(F.lit(0).cast("bigint"))
                  .select(F.concat("event_type", F.lit("-none")), F.lit(0).cast("bigint"))))
    hot = measured_hot_keys(events, "event_type", min_rows=1000, rows_per_salt=1000)
    return left_join(kinds, events, "event_type", hot)


def fact_star(spark, sf_dir):
    """Orders as appointments, parts of an order as treatments, returns as bills."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    appointments = orders.select(
        F.col("o_orderkey").alias("appointment_id"), F.col("o_custkey").alias("patient_id"),
        date_key("o_orderdate").alias("date_id"), F.col("o_orderstatus").alias("status"))
    treatments = lines.select(
        F.col("l_orderkey").alias("appointment_id"),
        F.col("l_partkey").alias("treatment_id")).distinct()
    bills = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("patient_id"),
                 F.col("l_partkey").alias("treatment_id"))
        .agg(money(F.sum(F.when(F.col("l_returnflag") != "N", cents("l_extendedprice")))).alias("amount")))
    # An order with very many lines would be a hot key; bills are unique by their key.
    hot = measured_hot_keys(
        lines.select(F.col("l_orderkey").alias("appointment_id")), "appointment_id")
    treated = left_join(appointments, treatments, "appointment_id", hot)
    return left_join(treated, bills, ["patient_id", "treatment_id"]).select(
        "appointment_id", "patient_id", "treatment_id", "date_id", "status", "amount")


# Aggregation, sort, top-1

def mode(spark, sf_dir):
    return most_common(_holed_customers(spark, sf_dir), "segment")


def value_frequency(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "lineitem"), "l_partkey")


def profile_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
        "l_partkey", as_real("l_extendedprice").alias("price"),
        F.lit(None).cast("string").alias("empty"),
        F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")).alias("line"))
    return column_profile(lines, ["flag", "status", "l_partkey", "price", "empty"], ["line"])


def profile_pruned(spark, sf_dir):
    """Modes of columns with many values, some tied; half of all prices are one value."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", as_real("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "N", F.lit(1.5)).otherwise(F.col("l_extendedprice")).alias("hot"),
        F.col("l_orderkey").alias("tied"), F.lit(None).cast("string").alias("empty"))
    return pruned_modes(lines, ["l_partkey", "price", "hot", "tied", "empty"])


def profile_deliveries(spark, sf_dir):
    """Line items in three deliveries, one of which arrives twice: profiled from stored states."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("R")).alias("flag"), "l_partkey",
        as_real("l_extendedprice").alias("price"), "l_quantity", "l_linenumber")
    columns = ["flag", "l_partkey", "price", "l_quantity"]
    stored = Deliveries(f"{scratch_dir(spark)}/states")
    for third in (0, 1, 0, 2):
        stored.add(f"part {third}", lines.where(F.col("l_linenumber") % 3 == third), columns)
    kinds = {c: lines.schema[c].dataType for c in columns}
    return profile_of_states(stored.states(spark), kinds, columns[:3], ["l_quantity"])


def sorted_treatments(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").orderBy(
        F.asc_nulls_first("p_retailprice"), "p_partkey")


# Filling

def fill_const(spark, sf_dir):
    return fill_constants(
        _holed_customers(spark, sf_dir), {"name": UNKNOWN, "segment": "OTHER", "nation": -1})


def fill_mode(spark, sf_dir):
    rows = _holed_customers(spark, sf_dir).withColumn("empty", F.lit(None).cast("string"))
    profile = Profile(rows, ["segment", "nation", "empty"])
    return fill(rows, {"segment": profile.mode("segment", UNKNOWN),
                       "nation": profile.mode("nation"),
                       "empty": profile.mode("empty", UNKNOWN)})


def fill_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_type") != "PROMO", F.col("p_size")).alias("size"))
    return fill(rows, {"size": Profile(rows, [], ["size"]).whole_mean("size")})


def fill_date(spark, sf_dir):
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status != "F", day).alias("born"), F.when(status != "O", day).alias("seen"))
    year = Profile(rows.select(F.year("born").alias("y")), ["y"]).mode("y")
    return fill(rows, {"born": F.make_date(year, F.lit(1), F.lit(1)),
                       "seen": run_date(AS_OF)})


# Calendar and trends

def _order_range(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


def calendar_full(spark, sf_dir):
    """The calendar between the first and the last order."""
    return calendar_for(_order_range(spark, sf_dir), "first", "last")


def calendar_compact(spark, sf_dir):
    """The compact calendar with the number of line items shipped on each day."""
    days = calendar_for(_order_range(spark, sf_dir), "first", "last", "compact")
    shipped = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_shipdate").cast("date").alias("date_key")).agg(F.count("*").alias("n_lines"))
    return days.join(shipped, "date_key", "left").fillna({"n_lines": 0})


def _order_trend(grain):
    def query(spark, sf_dir):
        fact = table(spark, sf_dir, "orders").select(
            date_key("o_orderdate").alias("date_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"))
        return trend(fact, calendar_full(spark, sf_dir), grain)
    return query


# Integrity

def pk_check(spark, sf_dir):
    return pk_violations(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def pk_bitmap(spark, sf_dir):
    """Order numbers of line items, some missing and some below zero."""
    keys = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey") - 2000).alias("k"))
    return pk_violations_by_bitmap(keys, "k")


def fk_check(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return fk_orphans(
        lines.select("l_orderkey", "l_partkey", F.nullif("l_suppkey", F.lit(0)).alias("l_suppkey")),
        {"l_orderkey": (orders.filter(F.col("o_orderstatus") != "P"), "o_orderkey"),
         "l_partkey": (table(spark, sf_dir, "part").filter(F.col("p_type") != "SMALL"),
                       "p_partkey"),
         "l_suppkey": (table(spark, sf_dir, "supplier"), "s_suppkey")})


def fk_unused(spark, sf_dir):
    """Orders that no line item names."""
    return fk_orphans(
        table(spark, sf_dir, "orders"),
        {"o_orderkey": (table(spark, sf_dir, "lineitem"), "l_orderkey")})


def null_check(spark, sf_dir):
    return null_counts(_holed_customers(spark, sf_dir), ["c_custkey", "name", "segment", "nation"])


# Sources and sinks

def csv_parquet_roundtrip(spark, sf_dir):
    """CSV out, CSV in with a declared schema, Parquet out and in."""
    root, source = scratch_dir(spark), table(spark, sf_dir, "customer")
    source.write.option("header", True).csv(f"{root}/customer.csv")
    files.write_parquet(
        files.read_csv(spark, f"{root}/customer.csv", source.schema), f"{root}/customer")
    return files.read_parquet(spark, f"{root}/customer")


def csv_inferred(spark, sf_dir):
    """CSV of an unregistered table, its types inferred."""
    root = scratch_dir(spark)
    table(spark, sf_dir, "part").write.option("header", True).csv(f"{root}/part.csv")
    found = files.read_csv(spark, f"{root}/part.csv")
    return found.select(F.col("p_partkey").cast("bigint").alias("p_partkey"),
                        "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def _orders_csv(spark, sf_dir):
    """Orders as CSV, with fields that are no value of their type."""
    path = f"{scratch_dir(spark)}/orders.csv"
    table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("c"), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
        .when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"),
                 F.when(F.col("o_orderpriority") == "1-URGENT", "?").otherwise("")).alias("o_orderdate"),
    ).write.option("header", True).csv(path)
    return path


_ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
           "o_orderdate date")


def _ingested_orders(spark, sf_dir):
    """The stored orders with their rejected values, and the account of the write."""
    schema = spark.createDataFrame([], _ORDERS).schema
    account = Account("orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    path = f"{scratch_dir(spark)}/orders"
    rows = files.read_csv(spark, _orders_csv(spark, sf_dir), schema, REJECTED)
    published.publish(account.watch(rows), path)
    return files.read_parquet(spark, path), account


def rejected_values(spark, sf_dir):
    """Fields of a CSV that were no value of their type, from the table that was stored."""
    return rejects(_ingested_orders(spark, sf_dir)[0], ["o_orderkey"])


def rejected_counts(spark, sf_dir):
    """Rows and rejected values by column, as counted by the write itself."""
    account = _ingested_orders(spark, sf_dir)[1]
    return spark.createDataFrame(
        [(c, account.rows, n) for c, n in account.rejected.items()], "name string, n_rows long, n_rejected long")


def infer_types(spark, sf_dir):
    """Types of the orders' text columns, and the least value that rules each narrower one out."""
    path = f"{scratch_dir(spark)}/text"
    spark.read.option("header", True).csv(_orders_csv(spark, sf_dir)).write.parquet(path)
    return type_report(spark.read.parquet(path))


def write_ignore(spark, sf_dir):
    """Two write-if-absent calls on one path: the first one stays."""
    root, source = scratch_dir(spark), table(spark, sf_dir, "supplier")
    files.write_parquet(source, f"{root}/supplier", "ignore")
    files.write_parquet(
        source.withColumn("s_name", F.lit("late")), f"{root}/supplier", "ignore")
    return files.read_parquet(spark, f"{root}/supplier")


def write_replace(spark, sf_dir):
    """Two replacing loads: the second one stays."""
    target, source = ParquetTarget(scratch_dir(spark)), table(spark, sf_dir, "supplier")
    load(source.withColumn("s_name", F.lit("early")), target, "supplier", "s_suppkey", "replace")
    load(source, target, "supplier", "s_suppkey", "replace")
    return target.read(spark, "supplier")


def insert_if_absent(spark, sf_dir):
    """Building customers are loaded first; the later load adds only the others."""
    target, source = ParquetTarget(scratch_dir(spark)), table(spark, sf_dir, "customer")
    load(source.filter(F.col("c_mktsegment") == "BUILDING"), target, "customer", "c_custkey")
    later = source.withColumn("c_name", F.concat(F.lit("late "), "c_name"))
    for _ in range(2):
        load(later, target, "customer", "c_custkey")
    return target.read(spark, "customer")


def insert_by_index(spark, sf_dir):
    """The same loads by a stored index of the keys; the last one follows rows from outside."""
    root, source = scratch_dir(spark), table(spark, sf_dir, "customer")
    target = IndexedParquetTarget(root)
    load(source.filter(F.col("c_mktsegment") == "BUILDING"), target, "customer", "c_custkey")
    later = source.withColumn("c_name", F.concat(F.lit("late "), "c_name"))
    load(later.filter(F.col("c_mktsegment") == "MACHINERY"), target, "customer", "c_custkey")
    target.append(later.filter(F.col("c_mktsegment") == "FURNITURE"), "customer")
    for _ in range(2):
        load(later, target, "customer", "c_custkey")
    return target.read(spark, "customer")


def absent_keys(spark, sf_dir):
    """Orders a load would add to those that had a line returned."""
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return absent_rows(table(spark, sf_dir, "orders"), returned, "o_orderkey", unique=True)


QUERIES = {
    "q_fact_star": fact_star,
    "q_project_rename": project_rename,
    "q_filter_not_null": filter_not_null,
    "q_drop_all_null": drop_all_null,
    "q_dedup": dedup,
    "q_dedup_rows": dedup_rows,
    "q_conform": conform_dim,
    "q_standardize_id": standardize_ids,
    "q_initcap_trim": initcap_trim,
    "q_full_name": full_names,
    "q_address_token": address_token,
    "q_cast_float": cast_real,
    "q_date_key": date_keys,
    "q_age": age,
    "q_event_timestamp": event_timestamps,
    "q_left_join_single": left_join_single,
    "q_left_join_composite": left_join_composite,
    "q_left_join_hot_keys": left_join_hot_keys,
    "q_mode": mode,
    "q_value_counts": value_frequency,
    "q_profile": profile_columns,
    "q_sorted_dim": sorted_treatments,
    "q_fill_const": fill_const,
    "q_fill_mode": fill_mode,
    "q_fill_mean": fill_mean,
    "q_fill_date": fill_date,
    "q_calendar": calendar_full,
    "q_calendar_compact": calendar_compact,
    "q_trend_year": _order_trend("year"),
    "q_trend_month": _order_trend("month"),
    "q_trend_week": _order_trend("week"),
    "q_pk_violations": pk_check,
    "q_fk_violations": fk_check,
    "q_fk_orphans": fk_unused,
    "q_null_counts": null_check,
    "q_csv_parquet_roundtrip": csv_parquet_roundtrip,
    "q_csv_infer_schema": csv_inferred,
    "q_write_ignore": write_ignore,
    "q_write_replace": write_replace,
    "q_insert_if_absent": insert_if_absent,
    "q_absent_rows": absent_keys,
    "q_profile_pruned": profile_pruned,
    "q_profile_deliveries": profile_deliveries,
    "q_pk_bitmap": pk_bitmap,
    "q_rejected_values": rejected_values,
    "q_rejected_counts": rejected_counts,
    "q_infer_types": infer_types,
    "q_insert_by_index": insert_by_index,
}
