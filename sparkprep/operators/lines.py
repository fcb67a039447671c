"""Dirty delimited files repaired line by line.

A file is a DataFrame of numbered lines ``(line_no, line)``, of which line 0 is
the header, or of ordered lines ``(ord, line)`` without the header, as
``read_ordered_lines`` gives them without counting.
After splitting, every row is ``(ord ARRAY<BIGINT>, cells ARRAY<STRING>)``.
``ord`` is the row's place in the file: original lines are ``[0, line_no]`` or
``[0] ++ ord``;
a row generated by step ``g`` from a parent is ``[g] ++ parent.ord ++ [pos]``,
so generated rows sort after every original row and in the order they were
made - the order a later step's "first seen" rule depends on.

"First seen per entity" is one aggregate over the candidate rows only:
``min(struct(ord, position, cells))`` per (entity, value). It is combined
map-side before the shuffle, so an entity holding a third of the rows never
lands whole in one task (a window over the entity would), and the winning
row's cells travel inside the aggregate: nothing is joined back.

Each step's pass-through rows stay on one chain of narrow projections; the
candidate rows of every step are written once to the shared folder, and the
rows a step generates are small side results pushed through the remaining
steps on their own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contacts as C
from ..functions.text import EDGE_SPACE

# Generation tags of the steps that add rows.
GEN_EXCESS, GEN_PHONES, GEN_EMAILS = 1, 2, 3


@dataclass
class LineSpec:
    """Layout of a dirty contacts file (positions are 0-based)."""
    header: list[str]
    delimiter: str = ";"
    quote: str = '"'
    id_pos: int = 0
    name_pos: int = 1
    email_pos: int = 2
    phone_pos: int = 3
    content_after_name: list[str] = field(default_factory=list)
    max_cells: int = 26

    @property
    def width(self) -> int:
        return len(self.header)


def _regex_literal(s: str) -> str:
    return "\\Q" + s + "\\E"


def _cell(cells: Column, i: int | Column) -> Column:
    """Null-safe 0-based element access (ANSI-safe)."""
    idx = (F.lit(i) if isinstance(i, int) else i) + 1
    return F.try_element_at(cells, idx)


def bind(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``expr`` as column ``name`` computed exactly once per row.

    Emitted by a one-element ``explode`` (a Generate), so later projections
    see a plain attribute and the optimizer cannot inline the (large) fold
    expression into every place that reads it."""
    return df.select("*", F.explode(F.array(expr)).alias(name))


def _set(cells: Column, i: int, value: Column) -> Column:
    return F.transform(cells, lambda x, j: F.when(j == i, value).otherwise(x))


# ---------------------------------------------------------------- D1, D2
def repair_quoted_delimiters_expr(line: Column, delimiter: str, quote: str) -> Column:
    """Inside every closed pair of quote chars drop the delimiters (the
    quotes stay); an unpaired last quote is ignored."""
    parts = F.split(line, _regex_literal(quote), -1)
    n = F.size(parts)
    fixed = F.transform(parts, lambda x, i: F.when((i % 2 == 1) & (i < n - 1),
                                                   F.replace(x, F.lit(delimiter), F.lit(""))).otherwise(x))
    return F.array_join(fixed, quote)


def repair_quoted_delimiters(lines: DataFrame, delimiter: str = ";", quote: str = '"') -> DataFrame:
    """D1 over the lines; the header (line 0) is left as is."""
    if "line_no" not in lines.columns:
        return lines.withColumn("line", repair_quoted_delimiters_expr(F.col("line"), delimiter, quote))
    return lines.withColumn("line", F.when(F.col("line_no") == 0, F.col("line"))
                            .otherwise(repair_quoted_delimiters_expr(F.col("line"), delimiter, quote)))


def split_cells(line: Column, delimiter: str) -> Column:
    return F.split(line, _regex_literal(delimiter), -1)


def malformed_lines(lines: DataFrame, delimiter: str, width: int | None = None) -> DataFrame:
    """Data lines whose cell count differs from the header's, with that
    count. The width defaults to that of line 0; ordered lines have no header
    among them and need it given."""
    n = F.size(split_cells(F.col("line"), delimiter))
    if "line_no" not in lines.columns and width is None:
        raise ValueError("ordered lines need the header's width")
    data = (lines.where(F.col("line_no") > 0) if "line_no" in lines.columns else lines).withColumn("n_cells", n)
    if width is not None:
        return data.where(F.col("n_cells") != width)
    width = lines.where(F.col("line_no") == 0).select(F.max(n)).scalar()
    return data.where(F.col("n_cells") != width)


def to_rows(lines: DataFrame, delimiter: str) -> DataFrame:
    """Data lines as ``(ord, cells)``."""
    if "line_no" not in lines.columns:
        return lines.select(F.concat(F.array(F.lit(0).cast("bigint")), "ord").alias("ord"),
                            split_cells(F.col("line"), delimiter).alias("cells"))
    return (lines.where(F.col("line_no") > 0)
            .select(F.array(F.lit(0).cast("bigint"), F.col("line_no").cast("bigint")).alias("ord"),
                    split_cells(F.col("line"), delimiter).alias("cells")))


# ------------------------------------------------------------ side results
def _materialize(df: DataFrame, enabled: bool) -> DataFrame:
    """Generated rows are few; written once to the shared folder and read
    back (``session.materialize``), they keep every later step from
    recomputing the chain that produced them."""
    if not enabled:
        return df
    from ..session import materialize
    return materialize(df)


def _gen_ord(gen: int, ord_: Column, pos: Column) -> Column:
    return F.concat(F.array(F.lit(gen).cast("bigint")), ord_, F.array(pos.cast("bigint")))


# -------------------------------------------------------------------- D3
def excess_map(rows: DataFrame, spec: LineSpec) -> DataFrame:
    """Narrow part of D3: ``cells`` becomes the kept cells; ``__pulled`` holds
    the digit-only cells taken out (spaces removed); ``__entity`` the id."""
    n, ep = spec.width, spec.email_pos
    c = F.col("cells")
    diff = F.size(c) - n
    cands = F.slice(c, ep + 1, F.greatest(diff, F.lit(0)))
    init = F.struct(F.lit(True).alias("go"), F.lit(0).alias("k"))

    def step(a, v):
        ok = a["go"] & ~F.contains(v, F.lit("@")) & F.replace(v, F.lit(" "), F.lit("")).rlike("^[0-9]+$")
        return F.when(ok, F.struct(F.lit(True).alias("go"), (a["k"] + 1).alias("k"))) \
                .otherwise(F.struct(F.lit(False).alias("go"), a["k"].alias("k")))

    staged = bind(rows.withColumns({"__diff": diff, "__entity": _cell(c, spec.id_pos)}),
                  "__k", F.aggregate(cands, init, step, lambda a: a["k"]))
    kk, dd = F.col("__k"), F.col("__diff")
    staged = staged.withColumns({
        "__kept0": F.concat(F.slice(c, 1, ep), F.slice(c, kk + ep + 1, F.size(c))),
        "__pulled": F.when(dd > 0, F.transform(F.slice(c, ep + 1, kk), lambda x: F.replace(x, F.lit(" "), F.lit("")))),
    })
    # the cell the loop stopped on (no '@') also loses its spaces
    stop = _cell(F.col("__kept0"), ep)
    kept = F.when((dd > 0) & (dd > kk) & ~F.contains(stop, F.lit("@")),
                  _set(F.col("__kept0"), ep, F.replace(stop, F.lit(" "), F.lit(""))))
    kept = kept.when(dd > 0, F.col("__kept0")).otherwise(c)
    return staged.withColumn("cells", kept).drop("__kept0", "__k")


def excess_copies(mapped: DataFrame, spec: LineSpec) -> DataFrame:
    """Generated part of D3: a pulled number becomes a copy of its row when
    the row is the entity's first over-wide row showing that number, either
    pulled or as the phone left on the row. A number pulled twice from one
    row gives two copies, so each row first groups its pulled cells by value
    (positions kept in an array, no shuffle); then one aggregate per
    (entity, number), combined map-side, picks the first row."""
    pp = spec.phone_pos
    remain = _cell(F.col("cells"), pp)
    pulled = F.col("__pulled")
    idx = F.sequence(F.lit(0), F.size(pulled) - 1)
    by_value = F.transform(F.array_distinct(pulled), lambda x: F.struct(
        x.alias("num"), F.lit(0).alias("kind"),
        F.filter(idx, lambda i: F.element_at(pulled, i + 1) == x).alias("poses")))
    left = F.when(F.length(remain) > 0, F.array(F.struct(
        remain.alias("num"), F.lit(1).alias("kind"), F.array().cast("array<int>").alias("poses"))))
    ev = F.concat(by_value, F.coalesce(left, F.array().cast("array<struct<num:string,kind:int,poses:array<int>>>")))
    events = (mapped.where(F.col("__diff") > 0)
              .select("__entity", "ord", "cells", F.explode(ev).alias("e"))
              .select("__entity", "ord", "cells", "e.num", "e.kind", "e.poses"))
    first = (events.groupBy("__entity", "num")
             .agg(F.min(F.struct("ord", "kind", "poses", "cells")).alias("f"))
             .where(F.col("f.kind") == 0))
    return (first.select("num", "f.ord", "f.cells", F.explode("f.poses").alias("pos"))
            .select(_gen_ord(GEN_EXCESS, F.col("ord"), F.col("pos")).alias("ord"),
                    _set(F.col("cells"), pp, F.col("num")).alias("cells")))


def repair_excess_cells(rows: DataFrame, spec: LineSpec) -> DataFrame:
    """D3: a row with more cells than the header loses, up to the surplus,
    the digit-only cells (spaces ignored, no '@') found at the e-mail
    position. Each pulled number the entity has not shown before (as a
    pulled number or as the phone left on an earlier such row) becomes a
    copy of the row with that phone (reference defect 4 fixed: one copy per
    number, the original row keeps its own phone)."""
    mapped = excess_map(rows, spec)
    copies = excess_copies(mapped, spec)
    return mapped.select("ord", "cells").unionByName(copies)


# ---------------------------------------------------------------- D5, D7
def _placed(cells: Column, pos: int, vals: Column, blank_when_none: bool) -> Column:
    """The cells with the first value found in its place; none found ->
    unchanged or ''."""
    none = _set(cells, pos, F.lit("")) if blank_when_none else cells
    return F.when(F.size(vals) >= 1, _set(cells, pos, F.try_element_at(vals, F.lit(1)))).otherwise(none)


def contacts_map(rows: DataFrame, pos: int, extract, blank_when_none: bool) -> DataFrame:
    """Narrow part of D5/D7: the first value found stays in the cell
    (``__vals`` keeps all of them)."""
    c = F.col("cells")
    staged = bind(rows, "__vals", extract(_cell(c, pos)))
    return staged.withColumn("cells", _placed(c, pos, F.col("__vals"), blank_when_none))


def contacts_copies(mapped: DataFrame, pos: int, entity_pos: int, gen: int) -> DataFrame:
    """Generated part of D5/D7: each further value becomes a row unless the
    entity showed it earlier (any value of an earlier multi-value row, or an
    earlier value of this row). First seen = ``min`` of (order, position)
    per entity and value, one aggregate combined map-side."""
    ev = (mapped.where(F.size("__vals") >= 2)
          .select("ord", "cells", _cell(F.col("cells"), entity_pos).alias("__entity"),
                  F.posexplode("__vals").alias("pos", "val")))
    first = ev.groupBy("__entity", "val").agg(F.min(F.struct("ord", "pos", "cells")).alias("f"))
    return (first.where(F.col("f.pos") >= 1)
            .select(_gen_ord(gen, F.col("f.ord"), F.col("f.pos")).alias("ord"),
                    _set(F.col("f.cells"), pos, F.col("val")).alias("cells")))


def _contacts_step(rows: DataFrame, pos: int, entity_pos: int, extract, gen: int, blank: bool) -> DataFrame:
    mapped = contacts_map(rows, pos, extract, blank)
    copies = contacts_copies(mapped, pos, entity_pos, gen)
    return mapped.select("ord", "cells").unionByName(copies)


def explode_phones(rows: DataFrame, spec: LineSpec) -> DataFrame:
    """The first number found in the phone cell stays on the row; each
    further number becomes a new row unless the entity (configured id,
    reference defect 6 fixed) already produced it; no number -> unchanged."""
    return _contacts_step(rows, spec.phone_pos, spec.id_pos, C.phone_numbers, GEN_PHONES, False)


def explode_emails(rows: DataFrame, spec: LineSpec) -> DataFrame:
    """As D5 for the e-mail cell; no address -> the cell becomes ''."""
    return _contacts_step(rows, spec.email_pos, spec.id_pos, C.emails, GEN_EMAILS, True)


# -------------------------------------------------------------------- D8
def merge_split_name(rows: DataFrame, spec: LineSpec) -> DataFrame:
    """Rows wider than ``max_cells`` whose cell after the name is not an
    allowed value get that cell joined to the name (with a space)."""
    c, npos = F.col("cells"), spec.name_pos
    allowed = F.array(*[F.lit(v) for v in spec.content_after_name]).cast("array<string>")
    nxt = _cell(c, npos + 1)
    merged = F.concat(F.slice(c, 1, npos), F.array(F.concat_ws(" ", _cell(c, npos), nxt)),
                      F.slice(c, npos + 3, F.size(c)))
    cond = (F.size(c) > spec.max_cells) & ~F.coalesce(F.array_contains(allowed, nxt), F.lit(False))
    return rows.withColumn("cells", F.when(cond, merged).otherwise(c))


def strip_rows(rows: DataFrame, delimiter: str) -> DataFrame:
    """Whitespace stripped from both ends of the whole line, then re-split."""
    line = F.regexp_replace(F.array_join("cells", delimiter), EDGE_SPACE, "")
    return rows.withColumn("cells", split_cells(line, delimiter))


# -------------------------------------------------------------------- D9
def rows_to_table(rows: DataFrame, spec: LineSpec, keep_order: bool = False,
                  on_error: str = "fail") -> DataFrame:
    """Cells -> named columns; short rows pad with null, longer rows abort
    the job (``on_error='fail'``) or are kept in ``_extra``."""
    c = F.col("cells")
    cols = [_cell(c, i).alias(name) for i, name in enumerate(spec.header)]
    too_long = F.size(c) > spec.width
    if on_error == "fail":
        guard = F.when(too_long, F.raise_error(F.concat(F.lit("row wider than header: "),
                                                         F.array_join(c, spec.delimiter))))
        cols[0] = F.coalesce(guard.cast("string"), cols[0]).alias(spec.header[0])
    else:
        cols.append(F.when(too_long, F.array_join(F.slice(c, spec.width + 1, F.size(c)), spec.delimiter))
                    .alias("_extra"))
    if keep_order:
        cols = [F.col("ord")] + cols
    return rows.select(*cols)


def repair_rows(lines: DataFrame, spec: LineSpec, materialize: bool = True) -> DataFrame:
    """D1 -> D3 -> D5 -> D7 -> strip -> D8, as ``(ord, cells)``.

    The big rows go through one chain of narrow projections that keeps each
    step's cells and found values. A single pass writes the candidate rows of
    all three steps (over-wide rows, rows with several phones or e-mails) to
    one small table. Each step's generated rows come from that table and the
    earlier generated rows, so the raw lines are read twice: once for the
    candidates and once for the output."""
    d = spec.delimiter
    lines = repair_quoted_delimiters(lines, d, spec.quote)
    m = excess_map(to_rows(lines, d), spec).withColumnRenamed("cells", "__cells_x")
    m = contacts_map(m.withColumn("cells", F.col("__cells_x")), spec.phone_pos, C.phone_numbers, False)
    m = m.withColumnsRenamed({"cells": "__cells_p", "__vals": "__vals_p"})
    m = contacts_map(m.withColumn("cells", F.col("__cells_p")), spec.email_pos, C.emails, True)
    m = m.withColumnRenamed("__vals", "__vals_e")
    # One cell array travels with a candidate: the later steps' cells follow
    # from it and from the values found.
    cand = m.where((F.col("__diff") > 0) | (F.size("__vals_p") >= 2) | (F.size("__vals_e") >= 2))
    cand = _materialize(cand.select("ord", "__cells_x", "__diff", "__entity", "__pulled", "__vals_p", "__vals_e"), materialize)
    cells_p = _placed(F.col("__cells_x"), spec.phone_pos, F.col("__vals_p"), False)
    cells_e = _placed(cells_p, spec.email_pos, F.col("__vals_e"), True)

    def step_rows(cells, vals):
        return cand.where(F.size(vals) >= 2).select("ord", cells.alias("cells"), F.col(vals).alias("__vals"))

    def via(rows, pos, extract, blank):
        return contacts_map(rows.select("ord", "cells"), pos, extract, blank)

    # generated rows come from the candidate table; the ones read by several
    # later steps are written once, the last one stays lazy (read once)
    c1 = _materialize(excess_copies(cand.where(F.col("__diff") > 0).select(
        "ord", F.col("__cells_x").alias("cells"), "__diff", "__entity", "__pulled"), spec), materialize)
    c1p = via(c1, spec.phone_pos, C.phone_numbers, False)
    c2 = _materialize(contacts_copies(step_rows(cells_p, "__vals_p").unionByName(c1p.select("ord", "cells", "__vals")),
                                      spec.phone_pos, spec.id_pos, GEN_PHONES), materialize)
    c1e = via(c1p, spec.email_pos, C.emails, True)
    c2e = via(c2, spec.email_pos, C.emails, True)
    e_cands = (step_rows(cells_e, "__vals_e").unionByName(c1e.select("ord", "cells", "__vals"))
               .unionByName(c2e.select("ord", "cells", "__vals")))
    c3 = contacts_copies(e_cands, spec.email_pos, spec.id_pos, GEN_EMAILS)
    rows = (m.select("ord", "cells").unionByName(c1e.select("ord", "cells"))
            .unionByName(c2e.select("ord", "cells")).unionByName(c3))
    return merge_split_name(strip_rows(rows, d), spec)


def lines_to_table(lines: DataFrame, spec: LineSpec, keep_order: bool = False,
                   on_error: str = "fail", materialize: bool = True) -> DataFrame:
    """The repair chain, then named columns."""
    return rows_to_table(repair_rows(lines, spec, materialize), spec, keep_order, on_error)
