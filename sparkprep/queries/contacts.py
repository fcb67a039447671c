"""Queries for contact extraction and the dirty-file repair chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contacts as C
from ..functions.text import EDGE_SPACE
from ..operators import lines as L
from ..session import work_path
from ..sources import raw_lines as RL
from .common import query, table

_ENDS = C.EMAIL_ENDINGS


def duck_phones(text: str) -> str:
    """DuckDB list of phone numbers of ``text`` (D4 oracle)."""
    fold = (f"list_reduce(regexp_extract_all(coalesce({text}, ''), '[0-9]+'), "
            "lambda st, x: case when length(st.acc || x) >= 9 "
            "then {'acc': '', 'out': list_append(st.out, st.acc || x)} "
            "else {'acc': st.acc || x, 'out': st.out} end, "
            "{'acc': '', 'out': []::varchar[]})")
    fin = ("case when st.acc = '' then st.out when len(st.out) > 0 then "
           "list_append(st.out, left(st.out[-1], length(st.out[-1]) - length(st.acc)) || st.acc) "
           "else st.out end")
    return (f"list_transform((select {fin} from (select {fold} as st)), "
            "lambda n: case when length(n) > 9 then '+' || n else n end)")


def _duck_email_step() -> str:
    bite = "replace(replace(lower(part), ' ', ''), chr(9), '')"
    pos = {e: f"strpos({bite}, '{e}')" for e in _ENDS}
    best_p = "greatest(" + ", ".join(f"(case when {p} > 1 then {p} else 0 end)" for p in pos.values()) + ")"
    best_n = "(case " + " ".join(f"when {pos[e]} = {best_p} then {len(e)}" for e in _ENDS) + " end)"
    end = f"({best_p} - 1 + {best_n})"
    local = (r"regexp_replace(regexp_replace(lower(replace(st.prev, ' ', '')), '^[^\p{L}\p{N}_]+', ''),"
             r" '[^\x00-\x7F]', '', 'g')")
    out = f"(case when length({local}) > 0 then list_append(st.out, {local} || '@' || left({bite}, {end})) else st.out end)"
    return (f"case when st.skip then {{'prev': part, 'skip': false, 'out': st.out}} "
            f"when {best_p} = 0 then {{'prev': part, 'skip': true, 'out': st.out}} "
            f"else {{'prev': substr({bite}, {end} + 1), 'skip': {end} >= length({bite}), 'out': {out}}} end")


def duck_emails(text: str) -> str:
    """DuckDB list of e-mails of ``text`` (D6 oracle)."""
    parts = f"string_split(coalesce({text}, ''), '@')"
    return (f"(list_reduce({parts}[2:], lambda st, part: {_duck_email_step()}, "
            f"{{'prev': {parts}[1], 'skip': false, 'out': []::varchar[]}})).out")


def _explode(df, key: str, arr, name: str):
    return (df.select(key, F.posexplode(arr).alias("pos", name))
              .withColumn("pos", F.col("pos").cast("bigint")))


@query("extract_phones", oracle=f"""
with l as (select doc_id, {duck_phones('text')} as nums from documents)
select doc_id, cast(unnest(generate_series(0, len(nums) - 1)) as bigint) as pos, unnest(nums) as phone from l""")
def extract_phones(spark, sf_dir):
    """D4 over whole document texts, one row per number found."""
    docs = table(spark, sf_dir, "documents")
    return _explode(docs, "doc_id", C.phone_numbers("text"), "phone")


# Addresses are rare in the texts, so each document gets some more around
# its text: several in a row, upper case, blanks and signs before and after,
# unknown endings, an ending inside a longer domain.
_MAILS_SPARK = """concat_ws(' ', case doc_id % 6
    when 0 then concat('Write to ( A.B', cast(doc_id as string), '@Mail.PT or c', cast(doc_id % 7 as string), '@shop.es;x@y.com')
    when 1 then concat('<user', cast(doc_id as string), '@host.internal> and ', cast(doc_id as string), '@x.org.uk')
    when 2 then concat('a@b@c.de @', cast(doc_id as string), '@k.biz@')
    when 3 then concat('é', cast(doc_id as string), '@mañana.eu ..z@q.net') end, text,
  case when doc_id % 4 = 0 then concat(source, '@', lang, '.com') end)"""
_MAILS_DUCK = _MAILS_SPARK.replace(" as string)", " as varchar)")


@query("extract_emails", oracle=f"""
with d as (select doc_id, {_MAILS_DUCK} as t from documents), l as (select doc_id, {duck_emails('t')} as mails from d)
select doc_id, cast(unnest(generate_series(0, len(mails) - 1)) as bigint) as pos, unnest(mails) as email from l""")
def extract_emails(spark, sf_dir):
    """D6 over whole document texts and addresses around them, one row per address found."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_MAILS_SPARK} as t")
    return _explode(docs, "doc_id", C.emails("t"), "email")


# ------------------------------------------------------------ dirty lines

CONTACT_SPEC = L.LineSpec(header=["id", "name", "email", "phone", "segment"], delimiter=";", quote='"',
                          id_pos=0, name_pos=1, email_pos=2, phone_pos=3,
                          content_after_name=["PT", "ES"], max_cells=5)
_HEADER_LINE = ";".join(CONTACT_SPEC.header)

# One dirty line per customer: entity id shared by three customers, names
# that split into two cells, stray phone cells, quoted delimiters, several
# phones or e-mails in one cell.
_LINE_SPARK = """concat_ws(';',
  concat('C', cast(c_custkey div 3 as string)),
  case when c_custkey % 9 = 0 then replace(c_name, '#', ';#') else c_name end,
  case when c_custkey % 7 = 0 then concat('93 ', lpad(cast(c_custkey % 10000000 as string), 7, '0')) end,
  case c_custkey % 5 when 0 then concat('user', cast(c_custkey as string), '@mail.pt user', cast(c_custkey div 3 as string), '@mail.com')
    when 1 then concat('USER', cast(c_custkey div 3 as string), '@Mail.PT')
    when 2 then 'none'
    when 3 then concat('x', cast(c_custkey % 50 as string), '@shop.es/y', cast(c_custkey div 3 as string), '@shop.es')
    else concat(' c', cast(c_custkey as string), '@x.com') end,
  case c_custkey % 4 when 0 then concat('21234', lpad(cast((c_custkey div 3) % 10000 as string), 4, '0'), '/9')
    when 1 then concat('+351 212 345 ', lpad(cast(c_custkey % 1000 as string), 3, '0'))
    when 2 then concat('91', lpad(cast(c_custkey div 3 as string), 7, '0'))
    else '' end,
  case when c_custkey % 6 = 0 then concat('"', substr(c_mktsegment, 1, 3), ';', substr(c_mktsegment, 4), '"')
    else c_mktsegment end)"""
_LINE_DUCK = """concat_ws(';',
  concat('C', cast(c_custkey // 3 as varchar)),
  case when c_custkey % 9 = 0 then replace(c_name, '#', ';#') else c_name end,
  case when c_custkey % 7 = 0 then concat('93 ', lpad(cast(c_custkey % 10000000 as varchar), 7, '0')) end,
  case c_custkey % 5 when 0 then concat('user', cast(c_custkey as varchar), '@mail.pt user', cast(c_custkey // 3 as varchar), '@mail.com')
    when 1 then concat('USER', cast(c_custkey // 3 as varchar), '@Mail.PT')
    when 2 then 'none'
    when 3 then concat('x', cast(c_custkey % 50 as varchar), '@shop.es/y', cast(c_custkey // 3 as varchar), '@shop.es')
    else concat(' c', cast(c_custkey as varchar), '@x.com') end,
  case c_custkey % 4 when 0 then concat('21234', lpad(cast((c_custkey // 3) % 10000 as varchar), 4, '0'), '/9')
    when 1 then concat('+351 212 345 ', lpad(cast(c_custkey % 1000 as varchar), 3, '0'))
    when 2 then concat('91', lpad(cast(c_custkey // 3 as varchar), 7, '0'))
    else '' end,
  case when c_custkey % 6 = 0 then concat('"', substr(c_mktsegment, 1, 3), ';', substr(c_mktsegment, 4), '"')
    else c_mktsegment end)"""


def contact_lines(spark, sf_dir):
    """``(line_no, line)``: a header line and one dirty line per customer."""
    cust = table(spark, sf_dir, "customer")
    header = spark.range(1).select(F.lit(0).cast("bigint").alias("line_no"), F.lit(_HEADER_LINE).alias("line"))
    body = cust.select((F.col("c_custkey") + 1).cast("bigint").alias("line_no"), F.expr(_LINE_SPARK).alias("line"))
    return header.unionByName(body)


def _ord_key(col="ord"):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ".")


def _as_lines(rows, delimiter=";"):
    return rows.select(_ord_key().alias("ord_key"), F.array_join("cells", delimiter).alias("line"))


# DuckDB oracle pieces: each returns CTE text reading ``src`` (ord, cells).
_D_LINES = f"""lines as (select 0::bigint as line_no, '{_HEADER_LINE}' as line
  union all select c_custkey + 1, {_LINE_DUCK} from customer)"""
_D_REPAIRED = """repaired as (select line_no, case when line_no = 0 then line else
  array_to_string(list_transform(string_split(line, '"'),
    lambda x, i: case when i % 2 = 0 and i < len(string_split(line, '"')) then replace(x, ';', '') else x end), '"')
  end as line from lines)"""
_D_ROWS = "rows0 as (select [0, line_no]::bigint[] as ord, string_split(line, ';') as cells from repaired where line_no > 0)"


def _d_set(cells: str, pos1: int, value: str) -> str:
    return f"list_concat({cells}[1:{pos1 - 1}], [{value}], {cells}[{pos1 + 1}:])"


def _d_excess(src: str, name: str) -> str:
    s = CONTACT_SPEC
    n, ep1, pp1, id1 = s.width, s.email_pos + 1, s.phone_pos + 1, s.id_pos + 1
    pred = r"lambda v: not contains(v, '@') and regexp_full_match(replace(v, ' ', ''), '[0-9]+')"
    return f"""{name}_a as (select ord, cells, len(cells) - {n} as diff, cells[{id1}] as ent,
    cells[{ep1}:{ep1 - 1} + greatest(len(cells) - {n}, 0)] as cands from {src}),
  {name}_b as (select *, coalesce(list_position(list_transform(cands, {pred}), false) - 1, len(cands)) as k from {name}_a),
  {name}_c as (select *, list_concat(cells[1:{ep1 - 1}], cells[k + {ep1}:]) as kept0 from {name}_b),
  {name}_d as (select ord, ent, diff, k, cells,
    case when diff <= 0 then cells
         when diff > k and not contains(kept0[{ep1}], '@') then {_d_set('kept0', ep1, f"replace(kept0[{ep1}], ' ', '')")}
         else kept0 end as kept,
    case when diff > 0 then list_transform(cells[{ep1}:{ep1 - 1} + k], lambda x: replace(x, ' ', '')) end as pulled
    from {name}_c),
  {name}_pulled as (select ent, ord, kept, unnest(generate_series(0, len(pulled) - 1)) as pos, unnest(pulled) as num
    from {name}_d where diff > 0),
  {name}_ev as (select ent, ord, num from {name}_pulled
    union all select ent, ord, kept[{pp1}] from {name}_d where diff > 0 and length(kept[{pp1}]) > 0),
  {name}_first as (select ent, num, min(ord) as f from {name}_ev group by ent, num),
  {name} as (select ord, kept as cells from {name}_d
    union all select list_concat([1]::bigint[], p.ord, [p.pos]::bigint[]), {_d_set('p.kept', pp1, 'p.num')}
    from {name}_pulled p join {name}_first f on p.ent = f.ent and p.num = f.num where p.ord = f.f)"""


def _d_explode(src: str, name: str, pos1: int, extract, gen: int, blank: bool) -> str:
    id1 = CONTACT_SPEC.id_pos + 1
    none = _d_set("cells", pos1, "''") if blank else "cells"
    return f"""{name}_a as (select ord, cells, {extract(f'cells[{pos1}]')} as vals from {src}),
  {name}_b as (select ord, vals, case when len(vals) >= 1 then {_d_set('cells', pos1, 'vals[1]')} else {none} end as cells
    from {name}_a),
  {name}_ev as (select ord, cells, cells[{id1}] as ent, unnest(generate_series(0, len(vals) - 1)) as pos,
    unnest(vals) as val from {name}_b where len(vals) >= 2),
  {name}_first as (select ent, val, min(list_append(ord, pos)) as f from {name}_ev group by ent, val),
  {name} as (select ord, cells from {name}_b
    union all select list_concat([{gen}]::bigint[], e.ord, [e.pos]::bigint[]), {_d_set('e.cells', pos1, 'e.val')}
    from {name}_ev e join {name}_first f on e.ent = f.ent and e.val = f.val
    where list_append(e.ord, e.pos) = f.f and e.pos >= 1)"""


def _d_strip_merge(src: str, name: str) -> str:
    s = CONTACT_SPEC
    np1 = s.name_pos + 1
    allowed = "[" + ", ".join(f"'{v}'" for v in s.content_after_name) + "]"
    return f"""{name}_s as (select ord, string_split(regexp_replace(array_to_string(cells, ';'), '{EDGE_SPACE}', '', 'g'), ';') as cells
    from {src}),
  {name} as (select ord, case when len(cells) > {s.max_cells} and not list_contains({allowed}, cells[{np1 + 1}])
      then list_concat(cells[1:{np1 - 1}], [concat_ws(' ', cells[{np1}], cells[{np1 + 1}])], cells[{np1 + 2}:])
      else cells end as cells from {name}_s)"""


def _d_lines_out(src: str) -> str:
    return f"select array_to_string(ord, '.') as ord_key, array_to_string(cells, ';') as line from {src}"


_PH = CONTACT_SPEC.phone_pos + 1
_EM = CONTACT_SPEC.email_pos + 1


@query("repair_delims", oracle=f"with {_D_LINES}, {_D_REPAIRED} select line_no, line from repaired")
def repair_delims(spark, sf_dir):
    """D1 over the dirty contact file."""
    return L.repair_quoted_delimiters(contact_lines(spark, sf_dir), ";", '"')


@query("malformed_lines", oracle=f"""with {_D_LINES}, {_D_REPAIRED}
select line_no, cast(len(string_split(line, ';')) as integer) as n_cells from repaired
where line_no > 0 and len(string_split(line, ';')) <> {CONTACT_SPEC.width}""")
def malformed_lines(spark, sf_dir):
    """Lines whose cell count differs from the header's, after D1."""
    lines = L.repair_quoted_delimiters(contact_lines(spark, sf_dir), ";", '"')
    return L.malformed_lines(lines, ";").select("line_no", "n_cells")


def _rows0(spark, sf_dir):
    lines = L.repair_quoted_delimiters(contact_lines(spark, sf_dir), ";", '"')
    return L.to_rows(lines, ";")


@query("repair_excess", oracle=f"with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS}, {_d_excess('rows0', 'ex')} {_d_lines_out('ex')}")
def repair_excess(spark, sf_dir):
    """D3: stray phone cells pulled out of over-wide rows, copies per new number."""
    return _as_lines(L.repair_excess_cells(_rows0(spark, sf_dir), CONTACT_SPEC))


@query("explode_phones", oracle=f"""with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS},
  {_d_explode('rows0', 'ph', _PH, duck_phones, 2, False)} {_d_lines_out('ph')}""")
def explode_phones(spark, sf_dir):
    """Several phones in one cell -> first stays, new ones become rows."""
    return _as_lines(L.explode_phones(_rows0(spark, sf_dir), CONTACT_SPEC))


@query("explode_emails", oracle=f"""with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS},
  {_d_explode('rows0', 'em', _EM, duck_emails, 3, True)} {_d_lines_out('em')}""")
def explode_emails(spark, sf_dir):
    """Several e-mails in one cell -> first stays, new ones become rows."""
    return _as_lines(L.explode_emails(_rows0(spark, sf_dir), CONTACT_SPEC))


@query("merge_name", oracle=f"with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS}, {_d_strip_merge('rows0', 'mg')} {_d_lines_out('mg')}")
def merge_name(spark, sf_dir):
    """A name split over two cells is joined back on over-wide rows."""
    rows = L.strip_rows(_rows0(spark, sf_dir), ";")
    return _as_lines(L.merge_split_name(rows, CONTACT_SPEC))


_TABLE_COLS = ", ".join(f"cells[{i + 1}] as {h}" for i, h in enumerate(CONTACT_SPEC.header))


@query("contacts_table", oracle=f"""with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS}, {_d_excess('rows0', 'ex')},
  {_d_explode('ex', 'ph', _PH, duck_phones, 2, False)}, {_d_explode('ph', 'em', _EM, duck_emails, 3, True)},
  {_d_strip_merge('em', 'mg')}
select array_to_string(ord, '.') as ord_key, {_TABLE_COLS},
  case when len(cells) > {CONTACT_SPEC.width} then array_to_string(cells[{CONTACT_SPEC.width + 1}:], ';') end as _extra
from mg""")
def contacts_table(spark, sf_dir):
    """The whole repair chain, then named columns (surplus cells kept in _extra)."""
    table_ = L.lines_to_table(contact_lines(spark, sf_dir), CONTACT_SPEC, keep_order=True, on_error="keep")
    return table_.withColumn("ord", _ord_key()).withColumnRenamed("ord", "ord_key")


def _contact_file(spark, sf_dir) -> str:
    """The dirty contact file as text, in parts."""
    path = work_path(spark, "text", unique=True) + "/contacts"
    contact_lines(spark, sf_dir).orderBy("line_no").select("line").write.text(path)
    return path


@query("malformed_file", oracle=f"""with {_D_LINES}, {_D_REPAIRED}
select line, cast(len(string_split(line, ';')) as integer) as n_cells from repaired
where line_no > 0 and len(string_split(line, ';')) <> {CONTACT_SPEC.width}""")
def malformed_file(spark, sf_dir):
    """D2 on a file: the header's width is read with the first line, the lines are scanned once."""
    lines, header = RL.read_ordered_lines(spark, _contact_file(spark, sf_dir))
    lines = L.repair_quoted_delimiters(lines, ";", '"')
    return L.malformed_lines(lines, ";", width=len(header.split(";"))).select("line", "n_cells")


@query("contacts_file", oracle=f"""with {_D_LINES}, {_D_REPAIRED}, {_D_ROWS}, {_d_excess('rows0', 'ex')},
  {_d_explode('ex', 'ph', _PH, duck_phones, 2, False)}, {_d_explode('ph', 'em', _EM, duck_emails, 3, True)},
  {_d_strip_merge('em', 'mg')}
select cast(ord[1] as bigint) as step, {_TABLE_COLS},
  case when len(cells) > {CONTACT_SPEC.width} then array_to_string(cells[{CONTACT_SPEC.width + 1}:], ';') end as _extra
from mg""")
def contacts_file(spark, sf_dir):
    """D9 on a file: ordered lines through the whole chain. The text is scanned
    twice (candidates, output) and nothing is counted or numbered."""
    lines, _ = RL.read_ordered_lines(spark, _contact_file(spark, sf_dir))
    found = L.lines_to_table(lines, CONTACT_SPEC, keep_order=True, on_error="keep")
    return found.withColumn("ord", F.col("ord")[0]).withColumnRenamed("ord", "step")
