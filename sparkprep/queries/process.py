"""Queries for masking (C7) and the pipeline (F1 flagship, F2)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..operators import mask as M
from ..plans import process as P
from ..session import work_path
from ..sources import snapshots as SN
from .common import query, table
from .standardize import (MESSY_CUSTOMER_DUCK, _DUCK_TAX, _MESSY_CUSTOMER_SPARK, _duck_clean_string,
                          _split_select, duck_float_oracle)


def _key(sf_dir):
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:10]


# ------------------------------------------------------------------ C7
@query("mask_dictionary", oracle="""
select 'names' as dictionary, count(*) as n_rows, count(distinct coalesce(c_name, 'nan')) as n_values,
  count(distinct coalesce(c_name, 'nan')) as n_keys, 0::bigint as n_conflicts from customer
union all
select 'segments', (select count(*) from customer),
  (select count(distinct v) from (select coalesce(c_mktsegment, 'nan') as v from customer
                                  union all select lower(c_mktsegment) from customer)),
  (select count(distinct v) from (select coalesce(c_mktsegment, 'nan') as v from customer
                                  union all select lower(c_mktsegment) from customer)), 0""")
def mask_dictionary(spark, sf_dir):
    """Names and segments masked with persistent dictionaries (two
    columns share 'segments'); reports rows, distinct values, distinct keys
    and conflicts (a value with two keys or a key with two values).

    The raw values ride along through the mask, so one pass gives the
    distinct (dictionary, value, key) pairs; one grouping-sets aggregate
    then counts keys per value and values per key."""
    refs = work_path(spark, "dictionaries", _key(sf_dir), unique=True)
    base = table(spark, sf_dir, "customer")
    cols = {"c_name": "names", "c_mktsegment": "segments", "segment_lower": "segments"}
    cust = base.select("c_name", "c_mktsegment", F.lower("c_mktsegment").alias("segment_lower"))
    cust = cust.select("*", *[F.coalesce(F.col(c), F.lit("nan")).alias(f"raw_{c}") for c in cols])
    masked = M.mask_columns(cust, refs, cols)
    pairs = (masked.select(F.explode(F.array(*[
                F.struct(F.lit(d).alias("dictionary"), F.col(f"raw_{c}").alias("v"), F.col(c).alias("k"))
                for c, d in cols.items()])).alias("p"))
             .select("p.*").distinct())
    per = (pairs.groupingSets([["dictionary", "v"], ["dictionary", "k"]], "dictionary", "v", "k")
           .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")))
    by_value = F.col("g") == 1   # grouped by (dictionary, v): k aggregated away
    stats = per.groupBy("dictionary").agg(
        F.count_if(by_value).alias("n_values"), F.count_if(~by_value).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_conflicts"))
    n_rows = base.agg(F.count(F.lit(1))).scalar()
    return stats.select("dictionary", n_rows.alias("n_rows"), "n_values", "n_keys", "n_conflicts")


_SALT = "sparkprep-demo-salt"


@query("mask_keyed", oracle=f"""select c_custkey, sha256(concat('{_SALT}', coalesce(c_name, 'nan'))) as c_name,
  sha256(concat('{_SALT}', coalesce(c_mktsegment, 'nan'))) as c_mktsegment from customer""")
def mask_keyed(spark, sf_dir):
    """C7 keyed variant: sha-256 of salt || value, no dictionary."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return M.mask_keyed(cust, ["c_name", "c_mktsegment"], _SALT)


# ------------------------------------------------------------------ F1
_F1_EXTRA_SPARK = [
    """case when c_custkey % 11 = 0 then null
            else date_format(date_add(date'1990-01-01', cast(c_custkey as int)), 'dd/MM/yyyy') end as reg_date""",
    """case when c_custkey % 13 = 0 then null
            else concat(cast(c_custkey div 100 as string), ',', lpad(cast(c_custkey % 100 as string), 2, '0')) end as balance_raw""",
]
_F1_EXTRA_DUCK = """,
  case when c_custkey % 11 = 0 then null
       else strftime(date '1990-01-01' + cast(c_custkey as integer), '%d/%m/%Y') end as reg_date,
  case when c_custkey % 13 = 0 then null
       else concat(cast(c_custkey // 100 as varchar), ',', lpad(cast(c_custkey % 100 as varchar), 2, '0')) end as balance_raw"""
F1_COLUMNS = ["c_custkey", "name_raw", "tax_raw", "qty_raw", "c_mktsegment", "reg_date", "balance_raw"]
F1_TYPES = {
    "names": "Nº Cliente,Nome,Imposto,Quantidade,Segmento,Data Registo,Saldo",
    "n_client_cols": "c_custkey",
    "str_cols": "name_raw,c_mktsegment",
    "nif_cols": "tax_raw",
    "int_cols": "qty_raw",
    "date_cols": {"cols": "reg_date", "global_format": "%d/%m/%Y"},
    "float_cols": "balance_raw",
    "optional": 0,
}


def messy_table(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return cust.selectExpr(*[e.strip() for e in _split_select(_MESSY_CUSTOMER_SPARK)], *_F1_EXTRA_SPARK) \
        .select(*F1_COLUMNS)


def _duck_int(expr: str) -> str:
    v = f"replace(regexp_replace(replace(replace(coalesce(cast({expr} as varchar), ''), ',', '.'), ' ', ''), '[.][^.]*$', ''), '.', '')"
    return f"(case when regexp_full_match({v}, '[0-9]+') then cast({v} as bigint) else 0 end)"


def _f1_oracle(messy_sql: str) -> str:
    floats = duck_float_oracle(["balance_raw"], "c_custkey", "select c_custkey, balance_raw from m", None)
    date = ("(case when length(coalesce(reg_date, '')) < 4 then '' "
            "else strftime(strptime(reg_date, '%d/%m/%Y'), '%Y%m%d_%H%M%S') end)")
    return f"""with m as ({messy_sql}),
f as ({floats})
select {_duck_int('m.c_custkey')} as n__cliente, {_duck_clean_string('name_raw')} as nome,
  {_DUCK_TAX} as imposto, {_duck_int('qty_raw')} as quantidade, {_duck_clean_string('c_mktsegment')} as segmento,
  {date} as data_registo, f.balance_raw as saldo
from m join f on m.c_custkey = f.c_custkey"""


_F1_MESSY_DUCK = f"select {MESSY_CUSTOMER_DUCK}{_F1_EXTRA_DUCK} from customer"


@query("standardize_table", oracle=_f1_oracle(_F1_MESSY_DUCK))
def standardize_table(spark, sf_dir):
    """F1 (flagship): a messy customer table standardised from a declared
    spec - dates, floats, tax ids, strings, ints, client numbers - then the
    column names."""
    return P.standardize_table(messy_table(spark, sf_dir), F1_TYPES)


# ------------------------------------------------------------------ F2
def _na_null(col: str) -> str:
    from ..sources.delimited import NA_LITERALS
    lits = ", ".join("'" + v.replace("'", "''") + "'" for v in NA_LITERALS)
    return f"case when {col} in ({lits}) then null else {col} end as {col}"


_F2_MESSY_DUCK = (f"select cast(c_custkey as varchar) as c_custkey, "
                  + ", ".join(_na_null(c) for c in F1_COLUMNS[1:])
                  + f" from ({_F1_MESSY_DUCK})")


@query("process_source", oracle=_f1_oracle(_F2_MESSY_DUCK))
def process_source(spark, sf_dir):
    """a messy customer CSV lands in an input folder; the configured
    source is processed (input chosen as of the run time, read as text,
    standardised) and written as a snapshot, which is read back."""
    base = work_path(spark, "process", _key(sf_dir), unique=True)
    inputs, outputs = f"{base}/input", f"{base}/output"
    (messy_table(spark, sf_dir).write.mode("overwrite").option("header", True).option("sep", ";")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{inputs}/customers_20240101_000000.csv"))
    spec = {
        "raw_source": {"load_parameters": {"path": inputs, "file_name": "customers", "file_type": "csv",
                                           "header_row": 0, "delimiter": ";", "encoding": "utf-8",
                                           "special_char": '"', "decimal": "."},
                       "type": {"specifics": "file"}},
        "data_types": F1_TYPES,
        "processed_source": {"save_parameters": {"path": outputs, "tag": "customers", "file_type": "parquet"}},
        "conf_file": {"refresh_rate": "day,1"},
    }
    result = P.process_source(spark, spec, src_time="20240102_000000")
    return result.data.drop("snapshot")


_Q_QTY = "case when c_custkey % 7 = 0 then '99999999999999999999' else cast(c_custkey % 100 as varchar) end"
_Q_DAY = "case when c_custkey % 10 = 3 then '31/02/2020' else '28/02/2020' end"
_Q_BAD = "c_custkey % 5 <> 4 and (c_custkey % 7 = 0 or c_custkey % 10 = 3)"


@query("process_quarantine", oracle=f"""with f as (select count(*) filter (where c_custkey % 5 <> 4 and not ({_Q_BAD})) as n_rows,
  count(*) filter (where {_Q_BAD}) as n_rejected, count(*) filter (where c_custkey % 5 = 4) as n_long,
  count(*) filter (where c_custkey % 5 <> 4 and c_custkey % 7 = 0) as n_failed_qty,
  count(*) filter (where c_custkey % 5 <> 4 and c_custkey % 10 = 3) as n_failed_day from customer)
select c_custkey as key, case when c_custkey % 7 = 0 then 0 else c_custkey % 100 end as qty,
  case when c_custkey % 10 = 3 then '' else '20200228_000000' end as day,
  case when {_Q_BAD} then concat_ws(',', case when c_custkey % 10 = 3 then 'day' end, case when c_custkey % 7 = 0 then 'qty' end) else '' end as reasons,
  f.* from customer, f where c_custkey % 5 <> 4""")
def process_quarantine(spark, sf_dir):
    """rows with a failed value are kept beside the snapshot, with their
    reasons; over-long rows are left out; all are counted by the write itself."""
    base = work_path(spark, "process", _key(sf_dir), unique=True)
    cust = table(spark, sf_dir, "customer")
    # A fifth of the lines have a cell too many.
    more = F.when(F.col("c_custkey") % 5 == 4, F.lit(";x")).otherwise(F.lit(""))
    spec = {
        "raw_source": {"type": {"specifics": "file"}, "load_parameters": {"path": f"{base}/input", "file_name": "customers", "delimiter": ";"}},
        "data_types": {"n_client_cols": "key", "int_cols": "qty", "date_cols": {"cols": "day", "global_format": "%d/%m/%Y"}},
        "on_error": "quarantine",
        "processed_source": {"save_parameters": {"path": f"{base}/output", "tag": "customers"}},
    }
    cells = F.concat_ws(";", F.col("c_custkey"), F.expr(_Q_QTY.replace("varchar", "string")), F.expr(_Q_DAY))
    body = cust.select(F.col("c_custkey").alias("n"), F.concat(cells, more).alias("line"))
    head = spark.createDataFrame([(0, "key;qty;day")], "n bigint, line string")
    lines = head.unionByName(body).repartition(1).sortWithinPartitions("n").select("line")
    lines.write.text(f"{base}/input/customers_20240101_000000.csv")
    done = P.process_source(spark, spec, src_time="20240102_000000")
    n = {f"n_{k}": v for k, v in done.counts.items() if k in ("rows", "rejected")}
    n |= {"n_long": done.counts["long_rows"], **{f"n_failed_{c}": done.counts["failed"][c] for c in ("qty", "day")}}
    both = (done.data.withColumn("reasons", F.lit("")).unionByName(done.rejected.withColumn("reasons", F.array_join("_errors", ",")).drop("_errors")))
    return both.drop("snapshot").withColumns({k: F.lit(v).cast("bigint") for k, v in n.items()})


@query("process_query_source", oracle="""with u as (select distinct c_custkey, c_nationkey from customer where c_nationkey < 10),
m as (select o_custkey, o_orderdate, o_totalprice from orders
      where o_orderdate >= timestamp '1998-01-01' - interval 3 month and o_orderdate < timestamp '1998-01-01' and o_orderstatus <> 'P')
select c_custkey as cliente, n.n_name as pais, cast(extract(month from o_orderdate) as bigint) as periodo, count(*) as encomendas
from m join u on o_custkey = c_custkey join nation n on n.n_nationkey = u.c_nationkey group by 1, 2, 3""")
def process_query_source(spark, sf_dir):
    """F2 on a query input: two steps, with time anchor, look-back, date
    part, substituted values, an auxiliary snapshot and a universe."""
    base = work_path(spark, "process", _key(sf_dir), unique=True)
    SN.write_snapshot(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), f"{base}/output",
                      "nations", "19970101_000000")
    table(spark, sf_dir, "orders").createOrReplaceTempView("sp_q_orders")
    table(spark, sf_dir, "customer").where("c_nationkey < 10").select("c_custkey", "c_nationkey").distinct() \
        .createOrReplaceTempView("sp_q_universe")
    spec = {
        "raw_source": {"type": {"specifics": "query"}, "load_parameters": {"query": [
            {"view": "sp_q_recent", "sql": """select * from IDENTIFIER(:source) where o_orderstatus <> :without
                and o_orderdate >= cast(:since as timestamp_ntz) - cast(:interval_dif as interval)
                and o_orderdate < cast(:since as timestamp_ntz)"""},
            {"view": "", "sql": """select c_custkey, n.name, date_part(:date_part, o_orderdate), count(*)
                from select_universe join sp_q_nations n on n.id = c_nationkey group by 1, 2, 3"""}]}},
        "query_manipulation": {
            "apply_on_1": {"time": {"since": {"format": "%Y-%m-%d %H:%M:%S", "ref": "yyyy0101_000000"}},
                           "substitute_values": {"source": "sp_q_orders", "without": "P"},
                           "time_groups": {"date_part": "MONTH"},
                           "time_difference": {"interval_dif": "date_part", "interval_t": 3}},
            "apply_on_2": {"insert_into": {"sp_q_nations": {"clean_source": "nations", "cols_needed": "n_nationkey, n_name",
                                                            "create_table": {"queries_cols_name": "id,name",
                                                                             "queries_cols_type": "bigint, string"}}},
                           "select_universe": {"type_join": "inner join", "main_table": "sp_q_recent",
                                               "selected_universe_table": "sp_q_universe", "join_on": ["o_custkey:c_custkey"]}},
            "apply_on_all": {"time_groups": {"date_part": "MONTH"}}},
        "data_types": {"names": "Cliente,\n Pais, Periodo,Encomendas", "n_client_cols": "Cliente", "int_cols": "Periodo, Encomendas"},
        "processed_source": {"save_parameters": {"path": f"{base}/output", "tag": "orders_by_period"}},
    }
    return P.process_source(spark, spec, src_time="19980615_000000").data.drop("snapshot")


@query("process_two_row_header", oracle=f"""select cast(p_size as bigint) as s_qty_2019,
  cast(cast(round(p_retailprice * 100) as bigint) as double) as s_price_2019, cast(p_size * 2 as bigint) as s_qty_2020,
  cast(cast(round(p_retailprice * 100) as bigint) * 2 as double) as s_price_2020, {_duck_clean_string('p_brand')} as b_name
from part""")
def process_two_row_header(spark, sf_dir):
    """F2 on a folder of files with a two-row header; classes grouped by micro tag."""
    base = work_path(spark, "process", _key(sf_dir), unique=True)
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cells = [F.col("p_partkey"), F.col("p_size"), cents, F.col("p_size") * 2, cents * 2, F.col("p_brand")]
    # One column of whole lines; the two header lines sort before the rows.
    body = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("n"), F.concat_ws(";", *cells).alias("line"))
    head = spark.createDataFrame([(-2, "Key;Stock 2019;;Stock 2020;;Brand"), (-1, "id;qty;price;qty;price;name")], "n bigint, line string")
    head.unionByName(body).orderBy("n").select("line").write.text(f"{base}/input/parts_20240101_000000.csv")
    spec = {
        "raw_source": {"type": {"specifics": "file"},
                       "load_parameters": {"path": f"{base}/input", "file_name": "parts", "delimiter": ";", "multilevel": True}},
        "data_types": {"macro_tags_names": "Stock, Brand", "micro_tags_names": "s,b", "duplicated_macro_tag": "year",
                       "int_cols": {"s": "qty_2019,\n qty_2020"}, "float_cols": {"s": "price_2019,price_2020"}, "str_cols": {"b": "name"}},
        "processed_source": {"save_parameters": {"path": f"{base}/output", "tag": "parts"}},
    }
    return P.process_source(spark, spec, src_time="20240102_000000").data.drop("snapshot")
