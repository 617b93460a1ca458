"""The same results in plain SQL for the checking engine, over the whole tables."""

from __future__ import annotations

from workload import clinic
from workload.operators import AS_OF


def _date(expression: str) -> str:
    return f"cast(cast({expression} as date) as varchar)"


def _mode(column: str, relation: str) -> str:
    return (f"(select {column} from {relation} where {column} is not null "
            f"group by {column} order by count(*) desc, {column} limit 1)")


def _initcap(text: str) -> str:
    return (f"array_to_string(list_transform(string_split({text}, ' '), "
            "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def _int_id(column: str, prefix: str) -> str:
    return f"try_cast(replace({column}, '{prefix}', '') as int)"


def _date_id(column: str) -> str:
    return f"cast(strftime(cast({column} as date), '%Y%m%d') as int)"


_HOLED = """(select c_custkey, case when c_nationkey > 4 then c_name end as name,
    nullif(c_mktsegment, 'BUILDING') as segment,
    case when c_acctbal > 0 then c_nationkey end as nation from customer)"""

_CALENDAR_COLUMNS = """
    cast(strftime(d, '%Y%m%d') as int) as date_id, cast(d as varchar) as full_date,
    cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
    cast(month(d) as int) as month_number, monthname(d) as month_name,
    cast(isodow(d) as int) as day_of_week, dayname(d) as day_name,
    cast(day(d) as int) as day_of_month, cast(weekofyear(d) as int) as week_of_year,
    isodow(d) in (6, 7) as is_weekend"""

_ORDER_DAYS = """(select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate),
    interval 1 day)) as date) as d from orders)"""


def _order_trend(keys: str) -> str:
    return f"""
    select {keys}, cast(count(*) as bigint) as n_appointments,
           cast(count(amount) as bigint) as n_billed,
           cast(sum(cast(amount as decimal(18,2))) as double) as revenue
    from (select cast(o_orderdate as date) as d,
                 case when o_orderstatus <> 'P' then o_totalprice end as amount from orders)
    group by all"""


# Cleaned tables as common table expressions. Each reads a raw relation named raw_<table>.

def _raw(name: str, text: str) -> str:
    return f"raw_{name} as ({clinic.relation(text)})"


_CLEAN_DOCTORS = f"""
d1 as (select distinct * from raw_doctors
       where doctor_id is not null or first_name is not null or last_name is not null),
d2 as (select * replace (
         trim({_initcap("first_name")}) as first_name,
         trim({_initcap("last_name")}) as last_name,
         trim({_initcap("specialization")}) as specialization,
         trim({_initcap("hospital_branch")}) as hospital_branch) from d1),
doctors as (
  select {_int_id("doctor_id", "D")} as doctor_id,
         coalesce(first_name, 'UNKNOWN') as first_name,
         coalesce(last_name, 'UNKNOWN') as last_name,
         coalesce(specialization, {_mode("specialization", "d2")}, 'UNKNOWN') as specialization,
         coalesce(phone_number, 'UNKNOWN') as phone_number,
         coalesce(years_experience,
                  cast(trunc((select coalesce(avg(years_experience), 0) from d2)) as int))
           as years_experience,
         coalesce(hospital_branch, 'Central Hospital') as hospital_branch, email,
         concat_ws(' ', coalesce(first_name, 'UNKNOWN'), coalesce(last_name, 'UNKNOWN'))
           as full_name
  from d2)"""

_CLEAN_PATIENTS = f"""
p0 as (select *, year(date_of_birth) as birth_year from raw_patients),
p1 as (select distinct * from p0
       where patient_id is not null or first_name is not null or last_name is not null),
patients as (
  select {_int_id("patient_id", "P")} as patient_id,
         coalesce(first_name, 'UNKNOWN') as first_name,
         coalesce(last_name, 'UNKNOWN') as last_name,
         coalesce(gender, {_mode("gender", "p0")}, 'UNKNOWN') as gender,
         cast(coalesce(date_of_birth,
              make_date({_mode("birth_year", "p0")}, 1, 1)) as varchar) as date_of_birth,
         contact_number, address,
         cast(coalesce(registration_date, date '{AS_OF}') as varchar) as registration_date,
         coalesce(insurance_provider, {_mode("insurance_provider", "p0")}, 'UNKNOWN')
           as insurance_provider,
         insurance_number, email, cast(birth_year as int) as birth_date_year,
         string_split(address, ' ')[2] as address_region,
         cast(year(date '{AS_OF}') - birth_year as int) as age,
         concat_ws(' ', {_initcap("coalesce(first_name, 'UNKNOWN')")},
                   {_initcap("coalesce(last_name, 'UNKNOWN')")}) as full_name
  from p1)"""

_CLEAN_APPOINTMENTS = f"""
a1 as (select distinct * from raw_appointments
       where appointment_id is not null or patient_id is not null or doctor_id is not null),
appointments as (
  select {_int_id("appointment_id", "A")} as appointment_id,
         {_int_id("patient_id", "P")} as patient_id,
         {_int_id("doctor_id", "D")} as doctor_id,
         cast(coalesce(appointment_date, date '{AS_OF}') as varchar) as appointment_date,
         appointment_time,
         coalesce(reason_for_visit, {_mode("reason_for_visit", "a1")}, 'UNKNOWN')
           as reason_for_visit,
         coalesce(status, {_mode("status", "a1")}, 'UNKNOWN') as status,
         strftime(try_cast(concat(cast(appointment_date as varchar), ' ',
                  lpad(appointment_time, 8, '0')) as timestamp), '%Y-%m-%d %H:%M:%S')
           as appointment_timestamp,
         {_date_id("appointment_date")} as date_id
  from a1)"""

_CLEAN_BILLING = f"""
b1 as (select distinct * from raw_billing
       where bill_id is not null or patient_id is not null or amount is not null),
billing as (
  select {_int_id("bill_id", "B")} as bill_id, {_int_id("patient_id", "P")} as patient_id,
         {_int_id("treatment_id", "T")} as treatment_id,
         cast(coalesce(bill_date, date '{AS_OF}') as varchar) as bill_date,
         cast(cast(amount as real) as double) as amount,
         coalesce(payment_method, {_mode("payment_method", "b1")}, 'UNKNOWN')
           as payment_method,
         coalesce(payment_status, {_mode("payment_status", "b1")}, 'UNKNOWN')
           as payment_status
  from b1)"""

_CLEAN_TREATMENTS = f"""
t1 as (select distinct * from raw_treatments
       where treatment_id is not null or treatment_type is not null),
t2 as (select * replace (cast(cost as real) as cost) from t1),
treatments as (
  select {_int_id("treatment_id", "T")} as treatment_id,
         {_int_id("appointment_id", "A")} as appointment_id,
         coalesce(treatment_type, {_mode("treatment_type", "t2")}, 'UNKNOWN')
           as treatment_type,
         description, cast(coalesce(cost, {_mode("cost", "t2")}) as double) as cost,
         cast(coalesce(treatment_date, date '{AS_OF}') as varchar) as treatment_date
  from t2)"""

_FACT = """
select a.appointment_id, a.patient_id, a.doctor_id, t.treatment_id, a.date_id,
       a.appointment_timestamp, a.status, b.amount, a.reason_for_visit
from appointments a left join treatments t on a.appointment_id = t.appointment_id
     left join billing b on a.patient_id = b.patient_id and t.treatment_id = b.treatment_id"""


def _fact_tables(holes: bool) -> str:
    return ",".join([
        _raw("appointments", clinic.appointments(holes)), _CLEAN_APPOINTMENTS,
        _raw("treatments", clinic.treatments(holes)), _CLEAN_TREATMENTS,
        _raw("billing", clinic.billing()), _CLEAN_BILLING])


def _doctors(holes: bool) -> str:
    return f"""with {_raw("doctors", clinic.doctors(holes))}, {_CLEAN_DOCTORS}"""


def _patients(holes: bool) -> str:
    return f"""with {_raw("patients", clinic.patients(holes))}, {_CLEAN_PATIENTS}"""


def _treatments(holes: bool) -> str:
    return f"""with {_raw("treatments", clinic.treatments(holes))}, {_CLEAN_TREATMENTS}"""


_DIM_DOCTORS = """
select doctor_id, full_name, specialization, years_experience, hospital_branch from doctors"""

_DIM_PATIENTS = """
select patient_id, full_name, gender, age, address_region, insurance_provider from patients"""

_DIM_TREATMENTS = "select treatment_id, treatment_type, description, cost from treatments"

# Orders with fields that are no value of their type, as text.
_ORDERS_TEXT = """(select o_orderkey, cast(o_orderkey as varchar) as k,
    case when o_orderstatus = 'P' then concat('c', o_custkey) else cast(o_custkey as varchar) end as c,
    case when o_orderpriority = '5-LOW' then 'n/a'
         when o_orderpriority <> '3-MEDIUM' then cast(o_totalprice as varchar) end as p,
    concat(strftime(o_orderdate, '%Y-%m-%d'), case when o_orderpriority = '1-URGENT' then '?' else '' end) as d,
    o_orderstatus as s from orders)"""

_TYPE_PATTERNS = {
    "boolean": "(?i)true|false", "int": "[+-]?[0-9]+", "bigint": "[+-]?[0-9]+",
    "double": "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?",
    "date": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "timestamp": "[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?"}


def _type_rows() -> str:
    """Every column by every type: how many values do not fit, and the least of them."""
    columns = {"o_orderkey": "k", "o_custkey": "c", "o_orderstatus": "s", "o_totalprice": "p", "o_orderdate": "d"}
    rows = []
    for name, c in columns.items():
        for at, (kind, pattern) in enumerate(_TYPE_PATTERNS.items()):
            fits = f"(regexp_full_match({c}, '{pattern}') and try_cast({c} as {kind}) is not null)"
            rows.append(
                f"select '{name}' as column, '{kind}' as type, {at} as place, count({c}) as n_values, "
                f"count(*) filter (where {c} is not null and not {fits}) as n_misfits, "
                f"min({c}) filter (where not {fits}) as least_misfit from {_ORDERS_TEXT}")
        rows.append(f"select '{name}', 'string', {len(_TYPE_PATTERNS)}, count({c}), 0, null from {_ORDERS_TEXT}")
    return " union all ".join(rows)


ORACLES = {
    "q_fact_star": """
        with t as (select distinct l_orderkey, l_partkey from lineitem),
        b as (select o_custkey, l_partkey,
                     sum(case when l_returnflag <> 'N'
                              then cast(l_extendedprice as decimal(18,2)) end) as amount
              from lineitem join orders on l_orderkey = o_orderkey
              group by o_custkey, l_partkey)
        select o.o_orderkey as appointment_id, o.o_custkey as patient_id,
               t.l_partkey as treatment_id,
               cast(strftime(o.o_orderdate, '%Y%m%d') as int) as date_id,
               o.o_orderstatus as status, cast(b.amount as double) as amount
        from orders o left join t on o.o_orderkey = t.l_orderkey
             left join b on o.o_custkey = b.o_custkey and t.l_partkey = b.l_partkey""",
    "q_project_rename": """
        select s_suppkey, s_name, s_nationkey as nation,
               concat_ws('-', s_name, s_nationkey) as label from supplier""",
    "q_filter_not_null": f"select * from {_HOLED} where segment is not null",
    "q_drop_all_null": f"""
        select * from {_HOLED}
        where name is not null or segment is not null or nation is not null""",
    "q_dedup": """
        select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem""",
    "q_dedup_rows": """
        select distinct * replace (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate)
        from lineitem""",
    "q_conform": """
        select cast(p_partkey as int) as treatment_id, p_type as treatment_type,
               p_name as description, cast(cast(p_retailprice as real) as double) as cost
        from part""",
    "q_standardize_id": """
        select c_custkey,
               try_cast(regexp_replace(c_name, 'Customer#', '', 'g') as int) as customer_id,
               try_cast(regexp_replace(concat(c_mktsegment, c_custkey), 'BUILDING', '', 'g')
                        as int) as segment_id
        from customer""",
    "q_initcap_trim": f"""
        select p_partkey, trim({_initcap("concat('  ', p_name, ' ', p_type)")}) as title
        from part""",
    "q_full_name": f"""
        select c_custkey, concat_ws(' ', segment, name) as full_name from {_HOLED}""",
    "q_address_token": """
        select p_partkey, string_split(p_name, ' ')[2] as second,
               string_split(p_brand, ' ')[2] as none from part""",
    "q_cast_float": """
        select l_orderkey, l_linenumber, l_partkey,
               cast(cast(l_extendedprice as real) as double) as price,
               cast(try_cast(l_returnflag as real) as double) as malformed from lineitem""",
    "q_date_key": """
        select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_id,
               case when o_orderstatus <> 'P'
                    then cast(cast(o_orderdate as date) as varchar) end as order_date
        from orders""",
    "q_age": """
        select o_orderkey, cast(2024 - year(o_orderdate) as int) as age from orders""",
    "q_event_timestamp": """
        select event_id, case when event_type <> 'error'
               then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') end as at
        from events""",
    "q_left_join_single": """
        select c_custkey, c_mktsegment, o_orderkey, o_totalprice
        from customer left join orders on c_custkey = o_custkey""",
    "q_left_join_composite": """
        select l.l_partkey, l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_returnflag,
               r.n_returned
        from lineitem l left join (
            select l_partkey, l_suppkey, count(*) filter (l_returnflag = 'R') as n_returned
            from lineitem group by l_partkey, l_suppkey) r
          on l.l_partkey = r.l_partkey and l.l_suppkey = r.l_suppkey""",
    "q_left_join_hot_keys": """
        select k.event_type, k.n_events, e.event_id, e.value
        from (select event_type, count(*) as n_events from events group by event_type
              union all select distinct concat(event_type, '-none'), 0 from events) k
             left join events e on k.event_type = e.event_type""",
    "q_mode": f"""
        select segment, count(*) as n from {_HOLED} where segment is not null
        group by segment order by n desc, segment limit 1""",
    "q_value_counts": """
        select l_partkey, count(*) as n from lineitem where l_partkey is not null
        group by l_partkey""",
    "q_profile": f"""
        with x as (select nullif(l_returnflag, 'R') as flag, nullif(l_linestatus, 'O') as status,
                          l_partkey, cast(l_extendedprice as real) as price,
                          case when l_linestatus = 'F' then l_linenumber end as line
                   from lineitem)
        select {_mode("flag", "x")} as mode_flag, {_mode("status", "x")} as mode_status,
               {_mode("l_partkey", "x")} as mode_l_partkey,
               cast({_mode("price", "x")} as double) as mode_price,
               cast(null as varchar) as mode_empty,
               (select avg(line) from x) as mean_line""",
    "q_sorted_dim": """
        select p_partkey, p_retailprice from part order by p_retailprice nulls first, p_partkey""",
    "q_fill_const": f"""
        select c_custkey, coalesce(name, 'UNKNOWN') as name,
               coalesce(segment, 'OTHER') as segment, coalesce(nation, -1) as nation
        from {_HOLED}""",
    "q_fill_mode": f"""
        with x as (select * from {_HOLED})
        select c_custkey, name, coalesce(segment, {_mode("segment", "x")}) as segment,
               coalesce(nation, {_mode("nation", "x")}) as nation, 'UNKNOWN' as empty
        from x""",
    "q_fill_mean": """
        select p_partkey, case when p_type <> 'PROMO' then p_size else
               (select cast(trunc(avg(p_size)) as int) from part where p_type <> 'PROMO')
               end as size from part""",
    "q_fill_date": f"""
        with x as (select o_orderkey, o_orderstatus as s, cast(o_orderdate as date) as d
                   from orders),
        y as (select year(d) as y from x where s <> 'F')
        select o_orderkey, cast(case when s <> 'F' then d
                                     else make_date({_mode("y", "y")}, 1, 1) end as varchar) as born,
               cast(case when s <> 'O' then d else date '{AS_OF}' end as varchar) as seen
        from x""",
    "q_calendar": f"select {_CALENDAR_COLUMNS} from {_ORDER_DAYS}",
    "q_calendar_compact": f"""
        select cast(d as varchar) as date_key, cast(year(d) as int) as year,
               cast(month(d) as int) as month, cast(day(d) as int) as day,
               dayname(d) as day_name, isodow(d) in (6, 7) as is_weekend,
               coalesce(n, 0) as n_lines
        from {_ORDER_DAYS} left join (
            select cast(l_shipdate as date) as shipped, count(*) as n from lineitem
            group by 1) l on d = shipped""",
    "q_trend_year": _order_trend("cast(year(d) as int) as year"),
    "q_trend_month": _order_trend(
        "cast(year(d) as int) as year, cast(month(d) as int) as month_number"),
    "q_trend_week": _order_trend(_date("date_trunc('week', d)") + " as week_start"),
    "q_pk_violations": """
        select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "q_fk_violations": """
        select 'l_orderkey' as fk, l_orderkey as key_value, count(*) as n_rows from lineitem
        where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
        group by l_orderkey
        union all
        select 'l_partkey', l_partkey, count(*) from lineitem
        where l_partkey not in (select p_partkey from part where p_type <> 'SMALL')
        group by l_partkey
        union all
        select 'l_suppkey', l_suppkey, count(*) from lineitem
        where l_suppkey <> 0 and l_suppkey not in (select s_suppkey from supplier)
        group by l_suppkey""",
    "q_fk_orphans": """
        select 'o_orderkey' as fk, o_orderkey as key_value, count(*) as n_rows from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
        group by o_orderkey""",
    "q_null_counts": f"""
        select count(*) filter (where c_custkey is null) as c_custkey,
               count(*) filter (where name is null) as name,
               count(*) filter (where segment is null) as segment,
               count(*) filter (where nation is null) as nation from {_HOLED}""",
    "q_csv_parquet_roundtrip": "select * from customer",
    "q_csv_infer_schema": "select * from part",
    "q_write_ignore": "select * from supplier",
    "q_write_replace": "select * from supplier",
    "q_insert_if_absent": """
        select * replace (case when c_mktsegment = 'BUILDING' then c_name
                               else concat('late ', c_name) end as c_name) from customer""",
    "q_absent_rows": """
        select * replace (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate)
        from orders where not exists (
            select 1 from lineitem where l_returnflag = 'R' and l_orderkey = o_orderkey)""",
    "q_clean_doctors": f"{_doctors(True)} select * from doctors",
    "q_clean_patients": f"{_patients(True)} select * from patients",
    "q_clean_appointments": f"""
        with {_raw("appointments", clinic.appointments())}, {_CLEAN_APPOINTMENTS}
        select * from appointments""",
    "q_clean_billing": f"""
        with {_raw("billing", clinic.billing_lines())}, {_CLEAN_BILLING}
        select * from billing""",
    "q_clean_treatments": f"""
        with {_raw("treatments", clinic.treatment_lines())}, {_CLEAN_TREATMENTS}
        select * from treatments""",
    "q_dim_doctors": f"{_doctors(True)} {_DIM_DOCTORS}",
    "q_dim_patients": f"{_patients(True)} {_DIM_PATIENTS}",
    "q_dim_treatments": f"{_treatments(True)} {_DIM_TREATMENTS}",
    "q_fact_appointments": f"with {_fact_tables(True)} {_FACT}",
    "q_clinic_trend_month": f"""
        with {_fact_tables(True)}, f as ({_FACT})
        select cast(date_id // 10000 as int) as year,
               cast(date_id // 100 % 100 as int) as month_number,
               count(*) as n_appointments, count(amount) as n_billed,
               cast(sum(cast(amount as decimal(18,2))) as double) as revenue
        from f group by all""",
    "q_fact_bucketed": f"with {_fact_tables(True)} {_FACT}",
    "q_rejected_casts": f"""
        with {_raw("appointments", clinic.appointments())}, {_CLEAN_APPOINTMENTS}
        select {_int_id("appointment_id", "A")} as appointment_id, {_date_id("appointment_date")} as date_id,
               'doctor_id' as column, doctor_id as raw
        from a1 where doctor_id is not null and {_int_id("doctor_id", "D")} is null
        union all
        select {_int_id("appointment_id", "A")}, {_date_id("appointment_date")}, 'appointment_timestamp',
               appointment_time
        from a1 where appointment_date is not null and appointment_time = 'noon'""",
    "q_rejected_values": f"""
        select o_orderkey, 'o_custkey' as column, c as raw from {_ORDERS_TEXT} where c like 'c%'
        union all select o_orderkey, 'o_totalprice', p from {_ORDERS_TEXT} where p = 'n/a'
        union all select o_orderkey, 'o_orderdate', d from {_ORDERS_TEXT} where d like '%?'""",
    "q_rejected_counts": f"""
        select 'o_orderkey' as name, count(*) as n_rows, 0 as n_rejected from orders
        union all select 'o_custkey', count(*), count(*) filter (where c like 'c%') from {_ORDERS_TEXT}
        union all select 'o_totalprice', count(*), count(*) filter (where p = 'n/a') from {_ORDERS_TEXT}
        union all select 'o_orderdate', count(*), count(*) filter (where d like '%?') from {_ORDERS_TEXT}""",
    "q_infer_types": f"""
        select "column", type, n_values, n_misfits, least_misfit,
               row_number() over (partition by "column", n_misfits = 0 order by place) = 1
                 and n_misfits = 0 as chosen
        from ({_type_rows()})""",
    "q_profile_pruned": f"""
        select {_mode("l_partkey", "lineitem")} as mode_l_partkey,
               {_mode("price", "(select cast(cast(l_extendedprice as real) as double) as price from lineitem)")}
                 as mode_price,
               {_mode("hot", "(select case when l_returnflag = 'N' then 1.5::double else l_extendedprice end as hot from lineitem)")}
                 as mode_hot,
               {_mode("l_orderkey", "lineitem")} as mode_tied, cast(null as varchar) as mode_empty""",
    "q_profile_deliveries": f"""
        select {_mode("flag", "(select nullif(l_returnflag, 'R') as flag from lineitem)")} as mode_flag,
               {_mode("l_partkey", "lineitem")} as mode_l_partkey,
               {_mode("price", "(select cast(cast(l_extendedprice as real) as double) as price from lineitem)")}
                 as mode_price,
               (select avg(l_quantity::double) from lineitem) as mean_l_quantity""",
    "q_pk_bitmap": """
        select k, count(*) as n from (
            select case when l_returnflag <> 'R' then l_orderkey - 2000 end as k from lineitem)
        group by k having count(*) > 1 or k is null""",
    "q_insert_by_index": """
        select * replace (case when c_mktsegment = 'BUILDING' then c_name
                               else concat('late ', c_name) end as c_name) from customer""",
    "q_medallion_date": f"""
        select {_CALENDAR_COLUMNS} from (
            select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) as d)""",
    "q_medallion_fact": f"with {_fact_tables(False)} {_FACT}",
    "q_medallion_doctors": f"{_doctors(False)} {_DIM_DOCTORS}",
    "q_medallion_patients": f"{_patients(False)} {_DIM_PATIENTS}",
    "q_medallion_treatments": f"{_treatments(False)} {_DIM_TREATMENTS}",
}
