"""Queries for readers and name/spec operators."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import functions as F

from ..operators import names as NM
from ..operators import standardize as S
from ..session import materialize, work_path
from ..sources import delimited as DL
from ..sources import headers as H
from ..sources import raw_lines as RL
from .common import query, table
from .contacts import _LINE_DUCK, _HEADER_LINE, contact_lines
from .standardize import _duck_clean_string


def _key(sf_dir):
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:10]


# ------------------------------------------------------------------ A1
@query("read_delimited", oracle="""select cast(c_custkey as varchar) as c_custkey, c_name,
  cast(c_nationkey as varchar) as c_nationkey,
  case when c_custkey % 10 = 0 then null else c_mktsegment end as c_mktsegment
from customer""")
def read_delimited(spark, sf_dir):
    """A1: a customer CSV (NA literals in it) written and read back as text."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/customer"
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_custkey") % 10 == 0, F.lit("N/A")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    (cust.write.mode("overwrite").option("header", True).option("sep", ";")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return DL.read_delimited(spark, path, delimiter=";")


@query("read_delimited_quoted", oracle="""select cast(c_custkey as varchar) as c_custkey,
  concat('"', c_name, '"; \\', c_mktsegment) as label, concat(c_mktsegment, '\\') as segment from customer""")
def read_delimited_quoted(spark, sf_dir):
    """A1: quotes, delimiters and backslashes inside quoted cells."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/customer"
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit('"'), "c_name", F.lit('"; \\'), "c_mktsegment").alias("label"),
        F.concat("c_mktsegment", F.lit("\\")).alias("segment"))
    cust.write.options(header=True, sep=";", escape='"', quoteAll=True).csv(path)
    return DL.read_delimited(spark, path, delimiter=";")


@query("read_delimited_multiline", oracle="""select cast(c_custkey as varchar) as c_custkey,
  concat(c_name, chr(10), '"', c_mktsegment, '",', chr(10), 'end') as note from customer""")
def read_delimited_multiline(spark, sf_dir):
    """A1 with line breaks and quotes inside cells."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/customer"
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('",\nend'))
    table(spark, sf_dir, "customer").select("c_custkey", note.alias("note")).write.options(header=True, escape='"').csv(path)
    return DL.read_delimited(spark, path, multi_line=True)


@query("read_delimited_multiline_split", oracle="""select cast(o_orderkey as varchar) as key,
  case o_orderkey % 4 when 0 then concat(o_orderstatus, chr(10), chr(10), '"', o_orderpriority, '"') when 1 then concat('"', o_orderstatus, ',', chr(10))
    when 2 then chr(10) else concat(o_orderpriority, ', 5" x') end as note, o_orderstatus as status from orders""")
def read_delimited_multiline_split(spark, sf_dir):
    """A1: one file, nearly every row with line breaks in a cell, read by many
    tasks: the file is cut into splits of about a sixteenth of it."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/orders"
    k = F.col("o_orderkey") % 4
    note = (F.when(k == 0, F.concat("o_orderstatus", F.lit('\n\n"'), "o_orderpriority", F.lit('"')))
            .when(k == 1, F.concat(F.lit('"'), "o_orderstatus", F.lit(",\n"))).when(k == 2, F.lit("\n"))
            .otherwise(F.concat("o_orderpriority", F.lit(', 5" x'))))
    orders = table(spark, sf_dir, "orders")
    orders.select(F.col("o_orderkey").alias("key"), note.alias("note"), F.col("o_orderstatus").alias("status")).coalesce(1) \
        .write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    with _small_splits(spark, size // 16):
        return materialize(DL.read_delimited(spark, path, multi_line=True, na_values=[]))


@contextmanager
def _small_splits(spark, size: int):
    """Splits of ``size`` bytes for what is read inside."""
    keys = {"spark.sql.files.maxPartitionBytes": str(max(size, 64)), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _write_in(spark, lines, path: str, charset: str, line_end: str = "\n") -> None:
    """One text file in a charset: the text sink writes a string's bytes as they are."""
    RL.allow_charset(spark, charset)
    encoded = F.encode(F.col("line"), charset).cast("string")
    lines.select(encoded.alias("value")).coalesce(1).write.options(lineSep=line_end, encoding=charset).text(path)


# Text with characters whose bytes look like a line feed beside others.
_WIDE_DUCK = """case c_custkey % 4 when 0 then concat(c_name, chr(2565), chr(19968)) when 1 then '' when 2 then concat(chr(2570), chr(256), ' ', c_mktsegment)
  else concat(c_mktsegment, chr(128512), chr(2560), chr(11), chr(2560)) end"""


def _wide_text():
    k, c = F.col("c_custkey") % 4, F.concat
    return (F.when(k == 0, c("c_name", F.lit("\u0a05\u4e00"))).when(k == 1, F.lit("")).when(k == 2, c(F.lit("\u0a0a\u0100 "), "c_mktsegment"))
            .otherwise(c("c_mktsegment", F.lit("\U0001f600\u0a00\u000b\u0a00"))))


@query("raw_lines_utf16", oracle=f"""select 'utf-16le' as charset, c_custkey as line_no, {_WIDE_DUCK} as line from customer
union all select 'utf-16be', c_custkey, {_WIDE_DUCK} from customer
union all select 'utf-32be', c_custkey, {_WIDE_DUCK} from customer""")
def raw_lines_utf16(spark, sf_dir):
    """A2 in UTF-16 and UTF-32, with blank lines and text whose bytes hold false
    line feeds; each file is read in several splits."""
    lines = table(spark, sf_dir, "customer").orderBy("c_custkey").select(_wide_text().alias("line"))
    out = None
    for charset in ("utf-16le", "utf-16be", "utf-32be"):
        path = work_path(spark, "text", _key(sf_dir), unique=True) + "/wide"
        _write_in(spark, lines, path, charset)
        size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
        with _small_splits(spark, size // 8):
            one = materialize(RL.read_raw_lines(spark, path, charset).select(F.lit(charset).alias("charset"), "line_no", "line"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("line_no", F.col("line_no").cast("bigint"))


@query("read_delimited_utf16", oracle=f"""select cast(c_custkey as varchar) as key, case when c_custkey % 4 = 1 then null else {_WIDE_DUCK} end as note
from customer""")
def read_delimited_utf16(spark, sf_dir):
    """A1 in UTF-16, lines ended by CRLF."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/wide"
    head = spark.createDataFrame([(0, "key;note")], "n bigint, line string")
    body = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("n"), F.concat(F.col("c_custkey").cast("string"), F.lit(";"), _wide_text()).alias("line"))
    _write_in(spark, head.unionByName(body).orderBy("n"), path, "utf-16le", "\r\n")
    return DL.read_delimited(spark, path, delimiter=";", encoding="utf-16")


# ------------------------------------------------------------------ A2
@query("raw_lines", oracle=f"""select 0::bigint as line_no, '{_HEADER_LINE}' as line
union all select c_custkey + 1, {_LINE_DUCK} from customer""")
def raw_lines(spark, sf_dir):
    """A2: the dirty contact file written as text in parts, read back as one
    ordered sequence of numbered lines."""
    path = work_path(spark, "text", _key(sf_dir), unique=True) + "/contacts"
    contact_lines(spark, sf_dir).orderBy("line_no").select("line").write.mode("overwrite").text(path)
    return RL.read_raw_lines(spark, path, across_files=True).select("line_no", "line")


@query("raw_lines_ansi", oracle="""select c_custkey as line_no,
  case when c_custkey % 5 = 0 then '' when c_custkey % 5 = 1 then '  ' else concat(c_name, ' café ', c_mktsegment) end as line
from customer""")
def raw_lines_ansi(spark, sf_dir):
    """A2 in windows-1252 with blank lines, which count."""
    path = work_path(spark, "text", _key(sf_dir), unique=True) + "/ansi"
    k = F.col("c_custkey") % 5
    line = F.when(k == 0, "").when(k == 1, "  ").otherwise(F.concat("c_name", F.lit(" café "), "c_mktsegment"))
    RL.allow_charset(spark, "windows-1252")
    # The text sink writes a string's bytes as they are.
    encoded = F.encode(line, "windows-1252").cast("string")
    table(spark, sf_dir, "customer").orderBy("c_custkey").select(encoded.alias("value")).write.text(path)
    return RL.read_raw_lines(spark, path, "ANSI", across_files=True).select("line_no", "line")


# ------------------------------------------------------------------ A4
@query("drop_unnamed", oracle="""select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, o_orderpriority
from orders""")
def drop_unnamed(spark, sf_dir):
    """A4: a CSV with a blank header cell; the unnamed column is dropped."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/orders"
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("x").alias(" "), "o_orderstatus",
                                              "o_orderpriority")
    o.write.mode("overwrite").option("header", True).csv(path)
    return H.drop_unnamed(DL.read_delimited(spark, path))


# ------------------------------------------------------------------ A5
_TOP = ["Key", "Stock 2019", "Unnamed: 2", "Stock 2020", "Unnamed: 4", "Brand"]
_SUB = ["id", "qty", "price", "qty", "price", "name"]


def _cents():
    return F.round(F.col("p_retailprice") * 100).cast("bigint")


def _two_row_header(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    body = part.select((F.col("p_partkey") + 1).alias("line_no"),
                       *[c.cast("string").alias(n) for c, n in zip(
                           [F.col("p_partkey"), F.col("p_size"), _cents(), F.col("p_size") * 2,
                            _cents() * 2, F.col("p_brand")], _TOP)])
    sub = spark.createDataFrame([(0, *_SUB)], ["line_no", *_TOP])
    return sub.unionByName(body)


_D_CENTS = "cast(round(p_retailprice * 100) as bigint)"


@query("flatten_header", oracle=f"""select cast(p_size as varchar) as s_qty_2019, cast({_D_CENTS} as varchar) as s_price_2019,
  cast(p_size * 2 as varchar) as s_qty_2020, cast({_D_CENTS} * 2 as varchar) as s_price_2020, p_brand as b_name
from part""")
def flatten_header(spark, sf_dir):
    """A5 with a year tag: both 'Stock' groups kept as s_<sub>_<year>."""
    return H.flatten_multilevel_header(_two_row_header(spark, sf_dir), ["Stock", "Brand"], ["s", "b"], "year")


@query("flatten_header_last", oracle=f"""select cast(p_size * 2 as varchar) as s_qty,
  cast({_D_CENTS} * 2 as varchar) as s_price from part""")
def flatten_header_last(spark, sf_dir):
    """A5 without a duplicate tag: only the last 'Stock' group is kept."""
    return H.flatten_multilevel_header(_two_row_header(spark, sf_dir), ["Stock"], ["s"])


@query("flatten_header_quoted", oracle=f"""select case when p_partkey % 3 = 0 then concat(p_brand, chr(10), '"', p_type, '"') else p_brand end as b_name,
  case when p_partkey % 5 = 0 then null else cast(p_size as varchar) end as s_qty_2019, cast(p_size * 2 as varchar) as s_qty_2020
from part where p_partkey % 7 <> 0""")
def flatten_header_quoted(spark, sf_dir):
    """A5 from a file, its body by A1's rules: line breaks and quotes in cells,
    NA literals, blank lines between, rows with a cell too many left out."""
    path = work_path(spark, "csv", _key(sf_dir), unique=True) + "/parts"
    quoted = F.concat(F.lit('"'), "p_brand", F.lit('\n""'), "p_type", F.lit('"""'))
    name = F.when(F.col("p_partkey") % 3 == 0, quoted).otherwise(F.col("p_brand"))
    size = F.when(F.col("p_partkey") % 5 == 0, F.lit("N/A")).otherwise(F.col("p_size").cast("string"))
    extra = F.when(F.col("p_partkey") % 7 == 0, F.lit(";x")).when(F.col("p_partkey") % 4 == 0, F.lit("\n")).otherwise(F.lit(""))
    body = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("n"), F.concat(
        F.concat_ws(";", size, (F.col("p_size") * 2).cast("string"), name), extra).alias("line"))
    head = spark.createDataFrame([(-2, "Stock 2019;Stock 2020;Brand"), (-1, "qty;qty;name")], "n bigint, line string")
    head.unionByName(body).orderBy("n").select("line").write.text(path)
    return H.read_two_row_header(spark, path, ["Stock", "Brand"], ["s", "b"], "year", delimiter=";", multi_line=True)


# ------------------------------------------------------------------ B1
_MESSY_NAMES = ["Nº Cliente", "Nome Completo", "País", "Saldo (€)", "Segmento Mercado"]


@query("std_names", oracle="""select c_custkey as n__cliente, c_name as nome_completo, c_nationkey as pa_s,
  c_acctbal as saldo____, c_mktsegment as segmento_mercado from customer""")
def std_names(spark, sf_dir):
    """B1: messy column names normalised (positional rename)."""
    cust = table(spark, sf_dir, "customer").toDF(*_MESSY_NAMES)
    return NM.standardize_names(cust)


# ------------------------------------------------------------------ B3
_WILD_SPEC = {"str_cols": "l_returnflag,l_line_#all-cols-starts-with#",
              "date_cols": {"cols": "l_ship_#all-cols-starts-with#",
                            "l_ship_#all-cols-starts-with#": "%Y-%m-%d %H:%M:%S"}}


@query("wildcard_select", oracle=f"""select l_orderkey, {_duck_clean_string('l_returnflag')} as l_returnflag,
  {_duck_clean_string('l_linenumber')} as l_linenumber, {_duck_clean_string('l_linestatus')} as l_linestatus,
  strftime(l_shipdate, '%Y%m%d_%H%M%S') as l_shipdate from lineitem""")
def wildcard_select(spark, sf_dir):
    """Class lists with prefix wildcards expanded against the table."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_linestatus",
                                                 "l_shipdate")
    spec = NM.expand_wildcards(_WILD_SPEC, li.columns)
    for tag in S.CLASS_ORDER:
        li = S.transform(li, tag, spec)
    return li


# ------------------------------------------------------------------ B5
_COVER_SPEC = {"int_cols": "o_orderkey, o_code", "n_client_cols": "o_custkey", "str_cols": "o_orderstatus,\n o_orderpriority",
               "nif_cols": "o_orderstatus", "float_cols": "o_totalprice,o_amount",
               "date_cols": {"cols": "o_orderdate,o_comment,o_due", "o_due": "%d-%m-%Y",
                             "global_format": "%Y-%m-%d %H:%M:%S"}}
#: column, classes, how many, status, condition of values that can't be parsed
_COVER_ROWS = [("o_orderkey", "int_cols", 1, "ok", "false"), ("o_code", "int_cols", 1, "ok", "o_orderkey % 6 = 0"),
               ("o_custkey", "n_client_cols", 1, "ok", "false"),
               ("o_orderstatus", "str_cols,nif_cols", 2, "multiple", "false"),
               ("o_totalprice", "float_cols", 1, "ok", "false"), ("o_amount", "float_cols", 1, "ok", "o_orderkey % 4 = 1"),
               ("o_orderdate", "date_cols", 1, "ok", "false"), ("o_orderpriority", "str_cols", 1, "ok", "false"),
               ("o_due", "date_cols", 1, "ok", "o_orderkey % 11 > 0 and o_orderkey % 7 = 0"),
               ("o_comment", "date_cols", 1, "missing", "false")]
#: The same text in both engines; columns with values that no class accepts.
_COVER_EXTRA = """case when o_orderkey % 11 = 0 then null when o_orderkey % 7 = 0 then '31-02-2020' else '28-02-2020' end as o_due,
  case when o_orderkey % 4 = 1 then 'n/k' when o_orderkey % 4 = 2 then null else '12,50' end as o_amount,
  case when o_orderkey % 6 = 0 then '99999999999999999999' else '17' end as o_code"""


def _cover_oracle():
    vals = ", ".join(f"('{c}', '{k}', {n}, '{s}')" for c, k, n, s, _ in _COVER_ROWS)
    there = [r for r in _COVER_ROWS if r[3] != "missing"]
    nulls = " ".join(f"when '{c}' then n_{c}" for c, *_ in there)
    bads = " ".join(f"when '{c}' then b_{c}" for c, *_ in there)
    counts = ", ".join(f"count(*) - count({c}) as n_{c}, count(*) filter (where {b}) as b_{c}" for c, _, _, _, b in there)
    return f"""with v(col_name, classes, n_classes, status) as (values {vals}),
o as (select *, {_COVER_EXTRA} from orders),
s as (select count(*) as n_rows, {counts} from o)
select col_name, classes, cast(n_classes as integer) as n_classes, status,
  case when status = 'missing' then null else n_rows end as n_rows,
  case col_name {nulls} end as n_null, case col_name {bads} end as n_unparsable
from v, s"""


@query("type_coverage", oracle=_cover_oracle())
def type_coverage(spark, sf_dir):
    """Declared classes per column, status, null and unparsable counts."""
    extra = [e.strip() for e in _COVER_EXTRA.split(",\n")]
    o = table(spark, sf_dir, "orders").selectExpr("*", *extra)
    return NM.type_coverage(o, _COVER_SPEC).withColumnRenamed("column", "col_name")
