"""Queries for the scalar standardisers (C1-C5) and their oracles.

Messy inputs are derived from clean driver tables with integer/string
arithmetic; the oracle derives them with the same expression in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import standardize as S
from .common import query, table

NON_WORD = T.NON_WORD


# ------------------------------------------------------------------ C1
def _duck_clean_string(c: str) -> str:
    return (f"regexp_replace(replace(replace(lower(replace(coalesce(cast({c} as varchar), ''), ' ', '')),"
            f" 'nan', ''), 'none', ''), '{NON_WORD}', '', 'g')")


@query("std_strings", oracle=f"""
select doc_id, lang, {_duck_clean_string('text')} as text_std, {_duck_clean_string('source')} as source_std
from documents""")
def std_strings(spark, sf_dir):
    """C1 on whole document texts (the heavy case: long Unicode text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source")
    return (S.strings(docs.withColumnsRenamed({"text": "text_std", "source": "source_std"}),
                      ["text_std", "source_std"]))


_MESSY_CUSTOMER_SPARK = """
  c_custkey,
  case c_custkey % 7 when 0 then null
       when 1 then concat(c_name, ' None')
       when 2 then concat('NaN ', c_mktsegment)
       when 3 then concat(' ', c_name, '-', cast(c_nationkey as string), ' ')
       when 4 then concat('João ', c_mktsegment, '.')
       when 5 then concat('Fernando_', cast(c_custkey as string))
       else c_name end as name_raw,
  case c_custkey % 6 when 0 then null
       when 1 then concat(' ', cast(c_custkey as string), '.0 ')
       when 2 then concat('PT-', cast(c_custkey as string))
       when 3 then 'NaN'
       when 4 then concat('A_', cast(c_custkey as string), ',7')
       else concat(cast(c_custkey div 10 as string), ' ', cast(c_custkey % 10 as string)) end as tax_raw,
  case c_custkey % 8 when 0 then replace(format_number(c_custkey * 1013, 0), ',', '.')
       when 1 then concat(cast(c_custkey as string), ',5')
       when 2 then concat('-', cast(c_custkey as string))
       when 3 then concat(' ', cast(c_custkey div 10 as string), ' ', cast(c_custkey % 10 as string), ' ')
       when 4 then 'abc'
       when 5 then null
       when 6 then concat('.', cast(c_custkey % 10 as string))
       else concat(cast(c_custkey % 10 as string), '.', cast(c_custkey % 7 as string), '.',
                   cast(c_custkey % 3 as string), '.', cast(c_custkey % 2 as string)) end as qty_raw,
  c_mktsegment
"""

MESSY_CUSTOMER_DUCK = """
  c_custkey,
  case c_custkey % 7 when 0 then null
       when 1 then concat(c_name, ' None')
       when 2 then concat('NaN ', c_mktsegment)
       when 3 then concat(' ', c_name, '-', cast(c_nationkey as varchar), ' ')
       when 4 then concat('João ', c_mktsegment, '.')
       when 5 then concat('Fernando_', cast(c_custkey as varchar))
       else c_name end as name_raw,
  case c_custkey % 6 when 0 then null
       when 1 then concat(' ', cast(c_custkey as varchar), '.0 ')
       when 2 then concat('PT-', cast(c_custkey as varchar))
       when 3 then 'NaN'
       when 4 then concat('A_', cast(c_custkey as varchar), ',7')
       else concat(cast(c_custkey // 10 as varchar), ' ', cast(c_custkey % 10 as varchar)) end as tax_raw,
  case c_custkey % 8 when 0 then replace(format('{:,}', c_custkey * 1013), ',', '.')
       when 1 then concat(cast(c_custkey as varchar), ',5')
       when 2 then concat('-', cast(c_custkey as varchar))
       when 3 then concat(' ', cast(c_custkey // 10 as varchar), ' ', cast(c_custkey % 10 as varchar), ' ')
       when 4 then 'abc'
       when 5 then null
       when 6 then concat('.', cast(c_custkey % 10 as varchar))
       else concat(cast(c_custkey % 10 as varchar), '.', cast(c_custkey % 7 as varchar), '.',
                   cast(c_custkey % 3 as varchar), '.', cast(c_custkey % 2 as varchar)) end as qty_raw,
  c_mktsegment
"""


def messy_customer(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(*[e.strip() for e in _split_select(_MESSY_CUSTOMER_SPARK)])


def _split_select(text: str) -> list[str]:
    """Split a select list on top-level commas."""
    out, depth, cur = [], 0, ""
    for ch in text:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    if cur.strip():
        out.append(cur)
    return out


@query("std_strings_customer", oracle=f"""
with m as (select {MESSY_CUSTOMER_DUCK} from customer)
select c_custkey, {_duck_clean_string('name_raw')} as name_raw, {_duck_clean_string('c_mktsegment')} as c_mktsegment
from m""")
def std_strings_customer(spark, sf_dir):
    """C1 on a messy customer name ('None'/'NaN' inside text, accents, null)."""
    return S.strings(messy_customer(spark, sf_dir).select("c_custkey", "name_raw", "c_mktsegment"),
                     ["name_raw", "c_mktsegment"])


# ------------------------------------------------------------------ C5
_DUCK_TAX = r"""replace(regexp_replace(split_part(split_part(lower(regexp_replace(coalesce(tax_raw, '0'),
  '^[\t\n\x0b\f\r\x1c-\x1f \x85\p{Z}]+|[\t\n\x0b\f\r\x1c-\x1f \x85\p{Z}]+$', '', 'g')), '.', 1), ',', 1),
  '[^\p{L}\p{N}_]', '0', 'g'), 'nan', '0')"""


@query("std_tax_ids", oracle=f"""
with m as (select {MESSY_CUSTOMER_DUCK} from customer)
select c_custkey, {_DUCK_TAX} as tax_raw from m""")
def std_tax_ids(spark, sf_dir):
    return S.tax_ids(messy_customer(spark, sf_dir).select("c_custkey", "tax_raw"), ["tax_raw"])


# ------------------------------------------------------------------ C4
_DUCK_INT = r"""(case when regexp_full_match(v, '[0-9]+') then cast(v as bigint) else 0 end)"""


@query("std_ints", oracle=f"""
with m as (select {MESSY_CUSTOMER_DUCK} from customer),
s as (select c_custkey,
  replace(regexp_replace(replace(replace(coalesce(qty_raw, ''), ',', '.'), ' ', ''), '[.][^.]*$', ''), '.', '') as v
  from m)
select c_custkey, {_DUCK_INT} as qty_raw from s""")
def std_ints(spark, sf_dir):
    return S.ints(messy_customer(spark, sf_dir).select("c_custkey", "qty_raw"), ["qty_raw"])


# ------------------------------------------------------------------ C3
_MESSY_FLOATS_SPARK = [
    "o_orderkey",
    "replace(format_number(o_orderkey * 1013, 0), ',', '.') as f_dots",
    "format_number(o_orderkey * 1013, 0) as f_commas",
    """case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then '12:30'
            when o_orderkey % 23 = 0 then '.'
            when o_orderkey % 10 = 0 then concat(cast(o_orderkey div 100 as string), ',', lpad(cast(o_orderkey % 100 as string), 2, '0'), '%')
            else concat(cast(o_orderkey div 100 as string), ',', lpad(cast(o_orderkey % 100 as string), 2, '0')) end as f_eu""",
    """concat(cast(o_orderkey div 1000 as string), '.', lpad(cast(o_orderkey % 1000 as string), 3, '0'), ',',
              lpad(cast(o_orderkey % 100 as string), 2, '0')) as f_mixed""",
    """case when o_orderkey % 5 = 0 then concat(cast(o_orderkey div 100 as string), ',', lpad(cast(o_orderkey % 100 as string), 2, '0'))
            else concat(cast(o_orderkey div 1000 as string), ',', lpad(cast(o_orderkey % 1000 as string), 3, '0')) end as f_hint""",
]
_MESSY_FLOATS_DUCK = """
  o_orderkey,
  replace(format('{:,}', o_orderkey * 1013), ',', '.') as f_dots,
  format('{:,}', o_orderkey * 1013) as f_commas,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then '12:30'
       when o_orderkey % 23 = 0 then '.'
       when o_orderkey % 10 = 0 then concat(cast(o_orderkey // 100 as varchar), ',', lpad(cast(o_orderkey % 100 as varchar), 2, '0'), '%')
       else concat(cast(o_orderkey // 100 as varchar), ',', lpad(cast(o_orderkey % 100 as varchar), 2, '0')) end as f_eu,
  concat(cast(o_orderkey // 1000 as varchar), '.', lpad(cast(o_orderkey % 1000 as varchar), 3, '0'), ',',
         lpad(cast(o_orderkey % 100 as varchar), 2, '0')) as f_mixed,
  case when o_orderkey % 5 = 0 then concat(cast(o_orderkey // 100 as varchar), ',', lpad(cast(o_orderkey % 100 as varchar), 2, '0'))
       else concat(cast(o_orderkey // 1000 as varchar), ',', lpad(cast(o_orderkey % 1000 as varchar), 3, '0')) end as f_hint
"""


def messy_floats(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*_MESSY_FLOATS_SPARK)


def _cnt(v: str, ch: str) -> str:
    return f"(length({v}) - length(replace({v}, '{ch}', '')))"


def duck_float_oracle(cols: list[str], key: str, source_sql: str, decimal: str | None) -> str:
    """DuckDB text of the C3 rule for ``cols`` of ``source_sql``: flags by
    a one-row aggregate, then the row steps as chained CTEs."""
    dec = "NULL" if decimal is None else f"'{decimal}'"
    prep = ", ".join(f"(case when {c} is null or {c} = '.' or {c} = '' then '-1' else {c} end) as {c}" for c in cols)
    flags = ", ".join(
        f"max({_cnt(c, '.')}) as {c}__md, max(cast({_cnt(c, '.')} = 1 as int)) as {c}__d1, "
        f"max({_cnt(c, ',')}) as {c}__mc, max(cast({_cnt(c, ',')} = 1 as int)) as {c}__c1, "
        f"max(cast(strpos({c}, '%') > 0 as int)) as {c}__pc" for c in cols)
    step2 = ", ".join(f"""(case when {c}__md > 1 then replace({c}, '.', '')
      when {c}__d1 = 1 and {dec} IS NOT DISTINCT FROM ',' then (case when strpos({c}, '.') > 1 and length(coalesce(string_split({c}, '.')[2], '')) > 2 then replace({c}, '.', '') else {c} end)
      when {c}__mc > 1 then replace({c}, ',', '')
      when {c}__c1 = 1 and {dec} IS NOT DISTINCT FROM '.' then (case when strpos({c}, ',') > 1 and length(coalesce(string_split({c}, ',')[2], '')) > 2 then replace({c}, ',', '') else {c} end)
      else {c} end) as {c}, {c}__pc""" for c in cols)
    step3 = ", ".join(f"(case when {c}__pc = 1 then replace({c}, '%', '') else {c} end) as {c}" for c in cols)
    step4 = ", ".join(f"""(case when {_cnt(c, ',')} = 1 and strpos({c}, '.') = 0 then replace({c}, ',', '.')
      when {_cnt(c, '.')} = 1 and strpos({c}, ',') = 0 then {c}
      when {_cnt(c, '.')} > 1 then replace(replace({c}, '.', ''), ',', '.')
      when strpos({c}, ',') > 0 and length(string_split({c}, ',')[-1]) = 2 and strpos({c}, '.') > 1
        then concat(regexp_replace(regexp_replace({c}, ',[^,]*$', ''), '[.,]', '', 'g'), '.', string_split({c}, ',')[-1])
      when strpos({c}, ':') > 1 then '-1' else {c} end) as {c}""" for c in cols)
    final = ", ".join(f"(case when cast(trim({c}) as double) = -1 then 0.0 else cast(trim({c}) as double) end) as {c}"
                      for c in cols)
    return f"""with src as ({source_sql}),
s1 as (select {key}, {prep} from src),
fl as (select {flags} from s1),
s2 as (select {key}, {step2} from s1 cross join fl),
s3 as (select {key}, {step3} from s2),
s4 as (select {key}, {step4} from s3)
select {key}, {final} from s4"""


_FLOAT_COLS = ["f_dots", "f_commas", "f_eu", "f_mixed"]


@query("std_floats", oracle=duck_float_oracle(_FLOAT_COLS, "o_orderkey",
                                              f"select {_MESSY_FLOATS_DUCK} from orders", None))
def std_floats(spark, sf_dir):
    """C3 over four messy float columns, flags of all four in one pass."""
    return S.floats(messy_floats(spark, sf_dir).select("o_orderkey", *_FLOAT_COLS), _FLOAT_COLS)


@query("std_floats_hint", oracle=duck_float_oracle(["f_hint"], "o_orderkey",
                                                   f"select {_MESSY_FLOATS_DUCK} from orders", "."))
def std_floats_hint(spark, sf_dir):
    """C3 with a decimal hint ('.'): 'k,ddd' thousands lose the comma."""
    return S.floats(messy_floats(spark, sf_dir).select("o_orderkey", "f_hint"), ["f_hint"], decimal=".")


# ------------------------------------------------------------------ C2
_MESSY_DATES_SPARK = [
    "o_orderkey",
    """case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then '12'
            else date_format(o_orderdate, 'dd/MM/yyyy') end as d_eu""",
    "date_format(o_orderdate, 'yyyy-MM-dd') as d_iso",
    "date_format(o_orderdate, 'd/M/yyyy') as d_unpadded",
    """concat(date_format(timestampadd(SECOND, o_orderkey % 86400, o_orderdate), 'yyyy-MM-dd HH:mm:ss'),
              '.', cast(o_orderkey % 1000 as string)) as d_frac""",
    """concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' ', lpad(cast(o_orderkey % 24 as string), 2, '0'), ':00') as d_space""",
    """case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
            when 1 then date_format(o_orderdate, 'dd/MM/yyyy') else date_format(o_orderdate, 'yyyyMMdd') end as d_mix""",
]
_MESSY_DATES_DUCK = """
  o_orderkey,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then '12'
       else strftime(o_orderdate, '%d/%m/%Y') end as d_eu,
  strftime(o_orderdate, '%Y-%m-%d') as d_iso,
  strftime(o_orderdate, '%-d/%-m/%Y') as d_unpadded,
  concat(strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S'), '.', cast(o_orderkey % 1000 as varchar)) as d_frac,
  concat(strftime(o_orderdate, '%Y-%m-%d'), ' ', lpad(cast(o_orderkey % 24 as varchar), 2, '0'), ':00') as d_space,
  case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y-%m-%d')
       when 1 then strftime(o_orderdate, '%d/%m/%Y') else strftime(o_orderdate, '%Y%m%d') end as d_mix
"""


def messy_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*_MESSY_DATES_SPARK)


def _duck_date(v: str, fmt: str, trim: str | None = None) -> str:
    src = f"coalesce({v}, '')"
    src = f"(case when length({src}) < 4 then '' else {src} end)"
    inner = src if trim is None else f"split_part({src}, '{trim}', 1)"
    return f"(case when {src} = '' then '' else strftime(strptime({inner}, '{fmt}'), '%Y%m%d_%H%M%S') end)"


@query("std_dates", oracle=f"""
with m as (select {_MESSY_DATES_DUCK} from orders)
select o_orderkey, {_duck_date('d_eu', '%d/%m/%Y')} as d_eu from m""")
def std_dates(spark, sf_dir):
    """C2 single format on dd/MM/yyyy text with nulls and too-short values."""
    df = messy_dates(spark, sf_dir).select("o_orderkey", "d_eu")
    return S.dates(df, {"cols": "d_eu", "global_format": "%d/%m/%Y"})


@query("std_dates_multi", oracle=f"""
with m as (select {_MESSY_DATES_DUCK} from orders)
select o_orderkey, {_duck_date('d_iso', '%Y-%m-%d')} as d_iso, {_duck_date('d_unpadded', '%d/%m/%Y')} as d_unpadded,
  {_duck_date('d_eu', '%d/%m/%Y')} as d_eu from m""")
def std_dates_multi(spark, sf_dir):
    """Own key for d_iso, ``other_formats`` for the rest (global ignored)."""
    df = messy_dates(spark, sf_dir).select("o_orderkey", "d_iso", "d_unpadded", "d_eu")
    spec = {"cols": "d_iso,d_unpadded,d_eu", "d_iso": "%Y-%m-%d", "other_formats": "%d/%m/%Y",
            "global_format": "%Y%m%d"}
    return S.dates(df, spec)


@query("std_dates_trim", oracle=f"""
with m as (select {_MESSY_DATES_DUCK} from orders)
select o_orderkey, {_duck_date('d_frac', '%Y-%m-%d %H:%M:%S', '.')} as d_frac,
  {_duck_date('d_space', '%Y-%m-%d', ' ')} as d_space from m""")
def std_dates_trim(spark, sf_dir):
    """A format ending '.' cuts at the first dot, ending '0' at the first space."""
    df = messy_dates(spark, sf_dir).select("o_orderkey", "d_frac", "d_space")
    return S.dates(df, {"cols": "d_frac,d_space", "d_frac": "%Y-%m-%d %H:%M:%S.", "d_space": "%Y-%m-%d0"})


_MIX = ["%Y-%m-%d", "%d/%m/%Y", "%Y%m%d"]
_DUCK_MIX_TS = "coalesce(" + ", ".join(f"try_strptime(d_mix, '{f}')" for f in _MIX) + ")"


@query("std_dates_mix", oracle=f"""
with m as (select {_MESSY_DATES_DUCK} from orders)
select o_orderkey, strftime({_DUCK_MIX_TS}, '%Y%m%d_%H%M%S') as d_mix from m""")
def std_dates_mix(spark, sf_dir):
    """C2d: a list of formats, the first that parses wins."""
    df = messy_dates(spark, sf_dir).select("o_orderkey", "d_mix")
    return S.dates(df, {"cols": "d_mix", "mix": ",".join(_MIX)})


_DUCK_DETECT = "case " + " ".join(f"when try_strptime(d_mix, '{f}') is not null then '{f}'" for f in _MIX) + " end"


@query("detect_format", oracle=f"""
with m as (select {_MESSY_DATES_DUCK} from orders)
select {_DUCK_DETECT} as fmt, count(*) as n from m group by 1""")
def detect_format(spark, sf_dir):
    """C2d's detector as a report: how many values each format matched."""
    df = messy_dates(spark, sf_dir)
    return df.groupBy(D.detect_format("d_mix", _MIX).alias("fmt")).agg(F.count(F.lit(1)).alias("n"))
