"""Queries for the relational operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import relational as R
from ..plans import script as S
from .common import query, table

SEGMENT = "BUILDING"
RUN_DATE = _dt.datetime(2000, 3, 31)


def _views(spark, sf_dir, *names):
    """Temp views ``sp_<table>`` over the driver tables (for SQL-text steps)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(f"sp_{n}")


# ------------------------------------------------------------------ B7
@query("project_distinct", oracle="select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def project_distinct(spark, sf_dir):
    return R.project_distinct(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])


# ------------------------------------------------------------------ E4
_UNIVERSE_SQL = f"(select c_custkey, c_mktsegment from customer where c_mktsegment = '{SEGMENT}') u"


def _universe_query(how):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
        universe = (table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == SEGMENT)
                    .select("c_custkey", "c_mktsegment"))
        return R.restrict_to_universe(orders, universe, ["o_custkey:c_custkey"], how)
    run.__doc__ = f"E4: orders x the {SEGMENT} customers, {how} join."
    return run


for _how, _sql in (("inner", "inner join"), ("left", "left join"), ("right", "right join"), ("full", "full join")):
    query(f"universe_{_how}", oracle=f"""select o_orderkey, o_custkey, o_totalprice, c_custkey, c_mktsegment
from orders {_sql} {_UNIVERSE_SQL} on orders.o_custkey = u.c_custkey""")(_universe_query(_how))
query("universe_semi", oracle=f"""select o_orderkey, o_custkey, o_totalprice from orders
where exists (select 1 from {_UNIVERSE_SQL} where u.c_custkey = orders.o_custkey)""")(_universe_query("semi"))
query("universe_anti", oracle=f"""select o_orderkey, o_custkey, o_totalprice from orders
where not exists (select 1 from {_UNIVERSE_SQL} where u.c_custkey = orders.o_custkey)""")(_universe_query("anti"))


@query("universe_multi", oracle="""select l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity from lineitem l
join (select distinct l_orderkey as ok, l_suppkey as sk from lineitem where l_returnflag = 'R') u
  on l.l_orderkey = u.ok and l.l_suppkey = u.sk""")
def universe_multi(spark, sf_dir):
    """E4 on two key pairs: line items of the (order, supplier) pairs that had a return."""
    li = table(spark, sf_dir, "lineitem")
    universe = R.project_distinct(li.where(F.col("l_returnflag") == "R")
                                  .select(F.col("l_orderkey").alias("ok"), F.col("l_suppkey").alias("sk")), ["ok", "sk"])
    out = R.restrict_to_universe(li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), universe,
                                 ["l_orderkey:ok", "l_suppkey:sk"], "inner")
    return out.drop("ok", "sk")


# ------------------------------------------------------------------ E6
_DUCK_PART = {"MONTH": "month", "WEEK": "week", "DAY": "day", "DOY": "doy"}


def _part_query(unit):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders")
        return R.group_by_date_part(
            orders, "o_orderdate", unit,
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"),
        ).withColumn("date_part", F.col("date_part").cast("int"))
    run.__doc__ = f"E6: orders grouped by {unit}."
    return run


for _unit in ("MONTH", "WEEK", "DAY", "DOY"):
    query(f"by_{_unit.lower()}", oracle=f"""select cast(date_part('{_DUCK_PART[_unit]}', o_orderdate) as integer) as date_part,
  count(*) as n_orders, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total_cents
from orders group by 1""")(_part_query(_unit))


# ------------------------------------------------------------------ E7
def _look_back_query(dif, n, part):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return R.look_back(orders, "o_orderdate", RUN_DATE, dif, n, part).drop("o_orderdate")
    run.__doc__ = f"E7: orders of the {n} {dif} ({part}) before the run date."
    return run


_ANCHOR = RUN_DATE.strftime("%Y-%m-%d %H:%M:%S")
for _name, (_dif, _n, _part, _iv) in {"look_back_days": ("days", 45, None, "45 day"),
                                      "look_back_months": ("date_part", 3, "MONTH", "3 month"),
                                      "look_back_week": ("date_part", 2, "WEEK", "14 day")}.items():
    query(_name, oracle=f"""select o_orderkey, o_custkey from orders
where o_orderdate >= timestamp '{_ANCHOR}' - interval {_iv} and o_orderdate < timestamp '{_ANCHOR}'""")(
        _look_back_query(_dif, _n, _part))


# ------------------------------------------------------------------ E2
@query("anchor_dates", oracle="""select o_orderkey,
  strftime(date_trunc('month', o_orderdate), '%Y%m%d_%H%M%S') as month_anchor,
  strftime(date_trunc('year', o_orderdate), '%Y%m%d_%H%M%S') as year_anchor,
  strftime(o_orderdate, '%Y') || '0615_120000' as mid_year
from orders""")
def anchor_dates(spark, sf_dir):
    """E2 per row: month, year and a fixed-day anchor of each order date."""
    o = table(spark, sf_dir, "orders")
    fmt = D.OUT_SPARK
    return o.select("o_orderkey",
                    F.date_format(D.anchor_date("o_orderdate", "yyyymm01_000000"), fmt).alias("month_anchor"),
                    F.date_format(D.anchor_date("o_orderdate", "yyyy0101_000000"), fmt).alias("year_anchor"),
                    F.date_format(D.anchor_date("o_orderdate", "yyyy0615_120000"), fmt).alias("mid_year"))


# ------------------------------------------------------------------ E1
_TIME = {"date_obj": _dt.datetime(2000, 3, 17),
         "since": {"format": "%Y-%m-%d %H:%M:%S", "ref": "yyyymm01_000000"},
         "until": {"format": "%Y-%m-%d %H:%M:%S"}}


@query("orders_since_anchor", oracle="""select o_orderkey, o_custkey from orders
where o_orderdate >= timestamp '2000-03-01 00:00:00' and o_orderdate < timestamp '2000-03-17 00:00:00'""")
def orders_since_anchor(spark, sf_dir):
    """Time tags filled from the run date (one anchored to the month)."""
    _views(spark, sf_dir, "orders")
    args = R.time_params(_TIME)
    return spark.sql("""select o_orderkey, o_custkey from sp_orders
        where o_orderdate >= cast(:since as timestamp_ntz) and o_orderdate < cast(:until as timestamp_ntz)""",
                     args=args)


# ------------------------------------------------------------------ E5
@query("param_filter", oracle=f"""select c_custkey, c_name, c_nationkey from customer
where c_mktsegment = '{SEGMENT}' and c_nationkey < 10""")
def param_filter(spark, sf_dir):
    """E5: a table name and values substituted as named parameters."""
    _views(spark, sf_dir, "customer")
    args = R.substitute_values({"tbl": "sp_customer", "seg": SEGMENT, "max_nation": 10})
    return spark.sql("""select c_custkey, c_name, c_nationkey from IDENTIFIER(:tbl)
        where c_mktsegment = :seg and c_nationkey < :max_nation""", args=args)


# ------------------------------------------------------------------ E8
@query("script_two_steps", oracle="""with per_customer as (
  select o_custkey, count(*) as n from orders where o_orderdate >= timestamp '1998-01-01' group by o_custkey)
select c_nationkey as nation, count(*) as n_customers, cast(sum(n) as bigint) as n_orders
from per_customer join customer on o_custkey = c_custkey group by c_nationkey""")
def script_two_steps(spark, sf_dir):
    """A two-step script (orders per customer -> per nation), parameters
    for one step and for the whole script, final column names given."""
    _views(spark, sf_dir, "orders", "customer")
    steps = [
        S.Step("sp_per_customer", """select o_custkey, count(*) as n from sp_orders
               where o_orderdate >= cast(:since as timestamp_ntz) group by o_custkey""",
               {"since": "1998-01-01 00:00:00"}),
        S.Step("", """select c_nationkey, count(*), sum(n) from sp_per_customer
               join IDENTIFIER(:customers) on o_custkey = c_custkey group by c_nationkey"""),
    ]
    return S.run_script(spark, steps, ["nation", "n_customers", "n_orders"], args={"customers": "sp_customer"})


@query("script_text", oracle="""with per_customer as (
  select o_custkey, count(*) as n from orders where o_orderdate >= timestamp '1998-01-01' group by o_custkey)
select c_nationkey as nation, count(*) as n_customers, cast(sum(n) as bigint) as n_orders
from per_customer join customer on o_custkey = c_custkey group by c_nationkey""")
def script_text(spark, sf_dir):
    """E8 as script text: the two steps as one Spark SQL script with a
    named parameter, run by Spark's own script support."""
    _views(spark, sf_dir, "orders", "customer")
    script = """
      CREATE OR REPLACE TEMPORARY VIEW sp_script_per_customer AS
        SELECT o_custkey, count(*) AS n FROM sp_orders
        WHERE o_orderdate >= cast(:since AS timestamp_ntz) GROUP BY o_custkey;
      CREATE OR REPLACE TEMPORARY VIEW sp_script_per_nation AS
        SELECT c_nationkey, count(*), sum(n) FROM sp_script_per_customer
        JOIN sp_customer ON o_custkey = c_custkey GROUP BY c_nationkey;
    """
    return S.run_sql_script(spark, script, "sp_script_per_nation", ["nation", "n_customers", "n_orders"],
                            args={"since": "1998-01-01 00:00:00"})
