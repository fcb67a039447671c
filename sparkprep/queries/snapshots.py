"""Queries for snapshots (A6-A12) and the auxiliary-source join.

Each query writes the order history, one snapshot per month of
``o_orderdate``, into the shared folder (``spark.checkpoint.dir``) and resolves
snapshots from it, so its time includes the writing."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import functions as F

from ..functions import dates as D
from ..plans import script as S
from ..session import work_path
from ..sources import snapshots as SN
from .common import query, table

_MONTH_SNAPSHOT_DUCK = "strftime(date_trunc('month', o_orderdate), '%Y%m%d_%H%M%S')"


def _key(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:10]


def order_history(spark, sf_dir) -> str:
    """Path of monthly order snapshots, written by each call."""
    path = SN.snapshot_path(work_path(spark, "history", _key(sf_dir), unique=True), "orders")
    month = F.date_format(F.date_trunc("month", "o_orderdate"), D.OUT_SPARK)
    return SN.write_snapshots_by(table(spark, sf_dir, "orders"), path, month)


def customer_snapshots(spark, sf_dir) -> str:
    """Root with two snapshots of tag ``customer`` (the second lower-cases
    the segment), written with the single-snapshot writer by each call."""
    root = work_path(spark, "sources", _key(sf_dir), unique=True)
    cust = table(spark, sf_dir, "customer")
    SN.write_snapshot(cust, root, "customer", "20240101_000000", product="aux")
    SN.write_snapshot(cust.withColumn("c_mktsegment", F.lower("c_mktsegment")), root, "customer",
                      "20240215_120000", product="aux")
    return root


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_DUCK_ORDER_COLS = ", ".join(_ORDER_COLS)


@query("snapshot_roundtrip", oracle=f"select {_DUCK_ORDER_COLS}, {_MONTH_SNAPSHOT_DUCK} as snapshot from orders")
def snapshot_roundtrip(spark, sf_dir):
    """A6 + A7: history written as monthly snapshots, read back whole."""
    return SN.read_snapshots(spark, order_history(spark, sf_dir)).select(*_ORDER_COLS, "snapshot")


@query("snapshot_list", oracle=f"select distinct {_MONTH_SNAPSHOT_DUCK} as snapshot from orders")
def snapshot_list(spark, sf_dir):
    """The snapshot names."""
    return SN.list_snapshots(spark, order_history(spark, sf_dir))


@query("snapshot_latest", oracle=f"""select {_DUCK_ORDER_COLS}, {_MONTH_SNAPSHOT_DUCK} as snapshot from orders
where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)""")
def snapshot_latest(spark, sf_dir):
    """The newest snapshot only (run-time partition pruning)."""
    return SN.read_latest(spark, order_history(spark, sf_dir)).select(*_ORDER_COLS, "snapshot")


@query("snapshot_on_date", oracle=f"""select {_DUCK_ORDER_COLS}, {_MONTH_SNAPSHOT_DUCK} as snapshot from orders
where date_trunc('month', o_orderdate) = timestamp '1998-03-01'""")
def snapshot_on_date(spark, sf_dir):
    """The latest snapshot of 1 March 1998."""
    return SN.read_on_date(spark, order_history(spark, sf_dir), "19980301").select(*_ORDER_COLS, "snapshot")


@query("snapshot_as_of", oracle=f"""select {_DUCK_ORDER_COLS}, {_MONTH_SNAPSHOT_DUCK} as snapshot from orders
where date_trunc('month', o_orderdate) = timestamp '1998-02-01'""")
def snapshot_as_of(spark, sf_dir):
    """A10: the last snapshot at or before 15 Feb 1998."""
    return SN.read_as_of(spark, order_history(spark, sf_dir), "19980215_000000").select(*_ORDER_COLS, "snapshot")


@query("snapshot_named", oracle="""select c_custkey, c_name, lower(c_mktsegment) as c_mktsegment,
  '20240215_120000' as snapshot from customer""")
def snapshot_named(spark, sf_dir):
    """A configured source read by name (mode 'recent')."""
    catalog = {"customers": {"root": customer_snapshots(spark, sf_dir), "product": "aux", "tags": ["customer"]}}
    return SN.read_named(spark, catalog, "customers").select("c_custkey", "c_name", "c_mktsegment", "snapshot")


@query("snapshot_schema_change", oracle="""select c_custkey, c_name, c_nationkey + 1 as c_region from customer""")
def snapshot_schema_change(spark, sf_dir):
    """The newest snapshot has a column more than the first, which a
    second write of the same name has replaced by no rows."""
    root, cust = work_path(spark, "schema", _key(sf_dir), unique=True), table(spark, sf_dir, "customer")
    SN.write_snapshot(cust.select("c_custkey", "c_name"), root, "customer", "20240101_000000")
    SN.write_snapshot(cust.select("c_custkey", "c_name").limit(0), root, "customer", "20240101_000000")
    new = cust.select("c_custkey", "c_name", (F.col("c_nationkey") + 1).alias("c_region"))
    SN.write_snapshot(new, root, "customer", "20240201_000000")
    path = SN.snapshot_path(root, "customer")
    old = SN.read_as_of(spark, path, "20240115_000000").select("c_custkey", "c_name", F.lit(0).alias("c_region"))
    return SN.read_latest(spark, path).drop("snapshot").unionByName(old)


@query("snapshot_commit", oracle="""select c_custkey, c_name, c_acctbal, '20240201_000000' as snapshot, 2::bigint as n_snapshots,
  false as stale, 'kept' as seen from customer
union all select c_custkey, c_name, c_acctbal, '20240101_000000', 2, false, 'first' from customer where c_nationkey < 10""")
def snapshot_commit(spark, sf_dir):
    """Two snapshots stand; then a re-run of the newest and the first
    write of a later one fail in their last rows. Neither is seen: the listing
    has two snapshots, the newest has its rows, and so has the one before; the
    freshness gate goes by the newest that stands."""
    root, cust = work_path(spark, "commit", _key(sf_dir), unique=True), table(spark, sf_dir, "customer")
    cust = cust.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    SN.write_snapshot(cust.where("c_nationkey < 10").drop("c_nationkey"), root, "customer", "20240101_000000")
    SN.write_snapshot(cust.drop("c_nationkey"), root, "customer", "20240201_000000")
    fails = F.when(F.col("c_nationkey") >= 0, F.raise_error(F.lit("a write that fails on purpose"))).otherwise(F.col("c_name"))
    bad = cust.withColumn("c_name", fails.cast("string")).drop("c_nationkey")
    for name in ("20240201_000000", "20240301_000000"):
        try:
            SN.write_snapshot(bad, root, "customer", name)
        except Exception as e:  # the failure is what this query is about
            if "fails on purpose" not in str(e):
                raise
        else:
            raise AssertionError("the write should fail")
    path = SN.snapshot_path(root, "customer")
    names = SN.snapshot_names(spark, path)
    gate = spark.createDataFrame([(_dt.datetime.strptime(names[-1], SN.TAG_FORMAT), "day", 7)], "last_snapshot timestamp, unit string, rate int")
    stale = SN.stale_sources(gate, _dt.datetime(2024, 2, 5)).select("stale")
    both = (SN.read_latest(spark, path).withColumn("seen", F.lit("kept"))
            .unionByName(SN.read_as_of(spark, path, "20240131_000000").withColumn("seen", F.lit("first"))))
    return both.withColumn("n_snapshots", F.lit(len(names)).cast("bigint")).withColumn("stale", stale.scalar())


@query("snapshot_text", oracle="""select c_custkey, concat('00', cast(c_custkey as varchar)) as code,
  concat(c_name, chr(10), '"x";', c_mktsegment) as note, case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then '' else '1e5' end as rate,
  '20240101_000000' as snapshot from customer""")
def snapshot_text(spark, sf_dir):
    """A6, A8 on text: a CSV snapshot comes back with the types, leading zeros,
    line breaks, quotes, empty and missing cells it was written with."""
    root, cust = work_path(spark, "text", _key(sf_dir), unique=True), table(spark, sf_dir, "customer")
    rate = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 1, F.lit("")).otherwise(F.lit("1e5"))
    out = cust.select("c_custkey", F.concat(F.lit("00"), F.col("c_custkey").cast("string")).alias("code"),
                      F.concat("c_name", F.lit('\n"x";'), "c_mktsegment").alias("note"), rate.alias("rate"))
    SN.write_snapshot(out, root, "customer", "20240101_000000", file_type="csv", delimiter=";")
    return SN.read_latest(spark, SN.snapshot_path(root, "customer"))


@query("snapshot_parts", oracle="""select c_custkey, c_mktsegment, case when c_nationkey < 12 then 'low' else 'whole' end as part
from customer where c_nationkey < 12 union all select c_custkey, c_mktsegment, 'whole' from customer""")
def snapshot_parts(spark, sf_dir):
    """A part's snapshots beside those of its tag; both are read."""
    root, cust = work_path(spark, "parts", _key(sf_dir), unique=True), table(spark, sf_dir, "customer")
    cust = cust.select("c_custkey", "c_mktsegment", "c_nationkey")
    SN.write_snapshot(cust.drop("c_nationkey"), root, "customer", "20240101_000000")
    SN.write_snapshot(cust.where("c_nationkey < 12").drop("c_nationkey"), root, "customer", "20240201_000000", part="low")
    whole = SN.read_latest(spark, SN.snapshot_path(root, "customer")).withColumn("part", F.lit("whole"))
    low = SN.read_latest(spark, SN.snapshot_path(root, "customer", part="low")).withColumn("part", F.lit("low"))
    return whole.unionByName(low).drop("snapshot")


_RUN = _dt.datetime(2001, 9, 1)


_UNITS = ("day", "week", "month", "year", "hour")
_UNIT_DUCK = "case o_custkey % 6 " + " ".join(f"when {i} then '{u}'" for i, u in enumerate(_UNITS)) + " end"
_ELAPSED_DUCK = " ".join(f"when '{u}' then date_sub('{u}', last, timestamp '2001-09-01')" for u in _UNITS)


@query("stale_customers", oracle=f"""with l as (
  select o_custkey, {_UNIT_DUCK} as unit, cast(o_custkey % 40 * 12 as integer) as rate, max(o_orderdate) as last
  from orders group by o_custkey)
select o_custkey, unit, rate, strftime(last, '%Y%m%d_%H%M%S') as last_order from l
where unit is null or (case unit {_ELAPSED_DUCK} end) > rate""")
def stale_customers(spark, sf_dir):
    """A12 as a table operator: customers whose last order is more than
    ``rate`` whole units before the run date; without a unit always stale."""
    units = F.array(*[F.lit(u) for u in _UNITS], F.lit(None).cast("string"))
    last = (table(spark, sf_dir, "orders").groupBy("o_custkey")
            .agg(F.max("o_orderdate").alias("last_snapshot"))
            .withColumns({"unit": F.element_at(units, (F.col("o_custkey") % 6 + 1).cast("int")),
                          "rate": (F.col("o_custkey") % 40 * 12).cast("int")}))
    out = SN.stale_sources(last, _RUN).where("stale")
    return out.select("o_custkey", "unit", "rate", F.date_format("last_snapshot", D.OUT_SPARK).alias("last_order"))


@query("aux_join", oracle="""select o_orderkey, c.c_custkey as cust_id, lower(c.c_mktsegment) as segment
from orders o join (select distinct c_custkey, c_mktsegment from customer) c on o.o_custkey = c.c_custkey""")
def aux_join(spark, sf_dir):
    """The latest auxiliary snapshot, needed columns only, de-duplicated,
    renamed and typed as declared, exposed to SQL and joined."""
    path = SN.snapshot_path(customer_snapshots(spark, sf_dir), "customer", "aux")
    S.register_aux(SN.read_latest(spark, path), "sp_aux_customer", columns=["c_custkey", "c_mktsegment"],
                   names=["cust_id", "segment"], types=["bigint", "string"])
    table(spark, sf_dir, "orders").createOrReplaceTempView("sp_orders")
    return spark.sql("select o_orderkey, cust_id, segment from sp_orders join sp_aux_customer on o_custkey = cust_id")
