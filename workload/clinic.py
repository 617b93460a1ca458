"""Clinic-shaped raw tables derived from the given tables.

One SQL text per table, run by Spark here and by the checking engine as part of the
comparison query, so both start from the same rows. The given tables hold no nulls and
no copies; the texts bring them in by ordinary conditions on the data: a value that is
missing for some nations, segments or states, and one more copy of the rows of a state.
``holes=False`` keeps the business IDs whole, for loads that check primary keys.
Spark takes the copies from the rows as they come, so that it makes each row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmart.schemas import RAW


class _Copied(str):
    """A text of rows and, once more, those of them that meet a condition."""

    body: str
    where: str

    def at_once(self) -> str:
        """The same rows from one pass over the body."""
        return (f"select x.* from ({self.body}) x lateral view "
                f"explode(case when {self.where} then array(1, 2) else array(1) end) copies as number")


def _copies(body: str, where: str) -> str:
    text = _Copied(f"select * from ({body}) x union all select * from ({body}) y where {where}")
    text.body, text.where = body, where
    return text


def _id(letter: str, key: str, hole: str, holes: bool) -> str:
    whole = f"concat('{letter}', {key})"
    return f"case when {hole} then null else {whole} end" if holes else whole


def doctors(holes: bool = True) -> str:
    body = f"""
    select {_id("D", "s_suppkey", "n_nationkey in (3, 4)", holes)} as doctor_id,
           case when n_nationkey in (4, 5) then null
                else concat('  ', lower(n_name), ' ann-LEE') end as first_name,
           case when n_nationkey in (4, 6) then null else concat(s_name, ' ') end as last_name,
           case when r_name = 'ASIA' then null else lower(r_name) end as specialization,
           case when s_acctbal < 0 then null else concat('555', s_suppkey) end as phone_number,
           case when n_nationkey < 5 then null else n_nationkey end as years_experience,
           case when r_name = 'EUROPE' then null
                else concat(lower(r_name), ' clinic') end as hospital_branch,
           concat(lower(s_name), '@hospital.com') as email
    from {{supplier}} join {{nation}} on s_nationkey = n_nationkey
         join {{region}} on n_regionkey = r_regionkey"""
    return _copies(body, "specialization = 'africa'")


def patients(holes: bool = True) -> str:
    body = f"""
    select {_id("P", "c_custkey", "c_nationkey in (23, 24)", holes)} as patient_id,
           case when c_nationkey in (3, 24) then null else lower(c_mktsegment) end as first_name,
           case when c_nationkey = 24 or c_acctbal < -900 then null else c_name end as last_name,
           case when c_nationkey < 5 then null when c_acctbal < 4000 then 'F'
                else 'M' end as gender,
           cast(first_date as date) as date_of_birth,
           concat('555', c_custkey) as contact_number,
           case when c_nationkey = 7 then 'abc'
                else concat(c_nationkey, ' ', c_mktsegment, ' St') end as address,
           cast(last_date as date) as registration_date,
           nullif(c_mktsegment, 'BUILDING') as insurance_provider,
           concat('INS', c_custkey) as insurance_number,
           concat(lower(c_name), '@mail.com') as email
    from {{customer}} left join (
        select o_custkey, min(urgent) as first_date, max(urgent) as last_date
        from (select o_custkey, case when o_orderpriority = '1-URGENT' then o_orderdate end as urgent
              from {{orders}}) u group by o_custkey) o
      on c_custkey = o_custkey"""
    return _copies(body, "gender = 'F'")


def appointments(holes: bool = True) -> str:
    hole = "o_orderpriority = '5-LOW' and o_orderstatus = 'P'"
    doctor = "case when supp is null then 'DX' else concat('D', supp) end"
    if holes:
        doctor = f"case when {hole} then null else {doctor} end"
    body = f"""
    select {_id("A", "o_orderkey", hole, holes)} as appointment_id,
           {_id("P", "o_custkey", hole + " and o_totalprice > 100000", holes)} as patient_id,
           {doctor} as doctor_id,
           case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then null
                else cast(o_orderdate as date) end as appointment_date,
           case when o_orderpriority = '2-HIGH' and o_orderstatus = 'O' then 'noon'
                else concat(cast(floor(o_totalprice) as bigint) % 24, ':15:00')
                end as appointment_time,
           nullif(o_orderpriority, '3-MEDIUM') as reason_for_visit,
           nullif(o_orderstatus, 'P') as status
    from {{orders}} left join (
        select l_orderkey, min(l_suppkey) as supp from {{lineitem}} group by l_orderkey) l
      on o_orderkey = l_orderkey"""
    return _copies(body, "status = 'F'")


def treatments(holes: bool = True) -> str:
    """One treatment per order that has line items."""
    body = f"""
    select {_id("T", "l_orderkey", "min(l_returnflag) = 'N'", holes)} as treatment_id,
           concat('A', l_orderkey) as appointment_id,
           case when min(l_returnflag) = 'A' then concat('A-', max(l_linestatus))
                when min(l_returnflag) = 'R' then 'R' end as treatment_type,
           case when min(l_linestatus) = 'F' then 'Standard' else 'Basic' end as description,
           case when count(*) = 1 then null
                else cast(min(cast(l_quantity as decimal(18,2))) as double) end as cost,
           case when max(l_linestatus) = 'F' then null
                else cast(min(l_shipdate) as date) end as treatment_date
    from {{lineitem}} group by l_orderkey"""
    return _copies(body, "treatment_type = 'R'")


def treatment_lines() -> str:
    """One treatment per line item, with almost as many costs as rows."""
    body = """
    select case when l_returnflag = 'N' and l_linestatus = 'F' then null
                else concat('T', l_orderkey) end as treatment_id,
           concat('A', l_orderkey) as appointment_id,
           case when l_returnflag = 'N' then null
                else concat(l_returnflag, '-', l_linestatus) end as treatment_type,
           concat('Part ', l_partkey) as description,
           case when l_quantity < 10 then null else l_extendedprice end as cost,
           case when l_linestatus = 'O' then null
                else cast(l_shipdate as date) end as treatment_date
    from {lineitem}"""
    return _copies(body, "treatment_type = 'A-F'")


def billing() -> str:
    """One bill per order with line items; those with return flag N cost nothing."""
    body = """
    select concat('B', o_orderkey) as bill_id, concat('P', o_custkey) as patient_id,
           concat('T', o_orderkey) as treatment_id,
           case when o_orderstatus = 'O' then null
                else cast(max(l_shipdate) as date) end as bill_date,
           cast(sum(case when l_returnflag <> 'N'
                         then cast(l_extendedprice as decimal(18,2)) end) as double) as amount,
           nullif(o_orderpriority, '4-NOT SPECIFIED') as payment_method,
           nullif(o_orderstatus, 'P') as payment_status
    from {orders} join {lineitem} on o_orderkey = l_orderkey
    group by o_orderkey, o_custkey, o_orderstatus, o_orderpriority"""
    return _copies(body, "payment_status = 'F'")


def billing_lines() -> str:
    """One bill per line item."""
    hole = "l_returnflag = 'R' and l_linestatus = 'O'"
    body = f"""
    select case when {hole} then null else concat('B', l_orderkey) end as bill_id,
           case when {hole} then null else concat('P', l_suppkey) end as patient_id,
           concat('T', l_partkey) as treatment_id,
           case when l_linestatus = 'F' then null else cast(l_shipdate as date) end as bill_date,
           case when l_quantity < 25 then null else l_extendedprice end as amount,
           nullif(l_returnflag, 'R') as payment_method,
           nullif(l_linestatus, 'O') as payment_status
    from {{lineitem}}"""
    return _copies(body, "payment_method = 'A'")


def names_of(text: str) -> list[str]:
    given = ("region", "nation", "customer", "supplier", "orders", "lineitem")
    return [n for n in given if "{" + n + "}" in text]


def rows(spark: SparkSession, sf_dir: str, text: str, table: str) -> DataFrame:
    """The derived table in Spark, with the declared raw types."""
    given = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names_of(text)}
    text = text.at_once() if isinstance(text, _Copied) else text
    return spark.sql(text, **given).to(RAW[table])


def relation(text: str) -> str:
    """The same table as SQL over the views of the checking engine."""
    return text.format(**{n: n for n in names_of(text)})
