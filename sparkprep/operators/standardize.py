"""Column-class standardisers over a DataFrame.

Each function keeps the plan one projection (``withColumns``); only the float
rule adds work: one global aggregate for the column-wide flags of every float
column (five small integers per column), used as literals."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as T
from .names import split_list

log = logging.getLogger(__name__)


def present_columns(wanted: list[str], have: list[str], optional: int = 0) -> list[str]:
    """B2: ``optional=1`` keeps only the columns that exist (warns for each
    missing one); ``optional=0`` raises when a column is missing."""
    missing = [c for c in wanted if c not in have]
    if missing and not optional:
        raise KeyError(f"columns not in the source: {missing}")
    for c in missing:
        log.warning("The column %s is not present on the source", c)
    return [c for c in wanted if c in have]


def _q(c: str) -> str:
    return f"`{c.replace('`', '``')}`"


ERRORS = "_errors"


def _with_errors(df: DataFrame, failed: dict[str, "F.Column"]) -> DataFrame:
    """``on_error='quarantine'``: append to ``_errors`` the names of the
    columns whose value failed (computed on the input, before replacement)."""
    if not failed:
        return df
    base = F.col(ERRORS) if ERRORS in df.columns else F.array().cast("array<string>")
    flags = F.filter(F.array(*[F.when(e, F.lit(c)) for c, e in failed.items()]), lambda x: x.isNotNull())
    return df.withColumn(ERRORS, F.concat(base, flags))


def _policy(on_error: str) -> str:
    if on_error not in ("fail", "sentinel", "quarantine"):
        raise ValueError("on_error must be 'fail', 'sentinel' or 'quarantine'")
    return "sentinel" if on_error == "quarantine" else on_error


def strings(df: DataFrame, cols: list[str], optional: int = 0, whole_value_only: bool = False) -> DataFrame:
    cols = present_columns(cols, df.columns, optional)
    return df.withColumns({c: T.clean_string(F.col(_q(c)), whole_value_only) for c in cols})


def tax_ids(df: DataFrame, cols: list[str], optional: int = 0) -> DataFrame:
    cols = present_columns(cols, df.columns, optional)
    return df.withColumns({c: T.clean_tax_id(F.col(_q(c))) for c in cols})


def ints(df: DataFrame, cols: list[str], optional: int = 0, on_error: str = "fail") -> DataFrame:
    cols = present_columns(cols, df.columns, optional)
    if on_error == "quarantine":
        df = _with_errors(df, {c: N.int_overflows(F.col(_q(c))) for c in cols})
    return df.withColumns({c: N.clean_int(F.col(_q(c)), _policy(on_error)) for c in cols})


def dates(df: DataFrame, date_params: dict, optional: int = 0, on_error: str = "fail",
          as_timestamp: bool = False) -> DataFrame:
    """C2 with the per-column format choice of C2b; ``date_params['cols']``
    is a comma-separated list or a list."""
    cols = present_columns(split_list(date_params["cols"]), df.columns, optional)
    if on_error == "quarantine":
        df = _with_errors(df, {c: D.date_fails(F.col(_q(c)), D.choose_format(c, date_params)) for c in cols})
    return df.withColumns({
        c: D.clean_date(F.col(_q(c)), D.choose_format(c, date_params), _policy(on_error), as_timestamp)
        for c in cols
    })


FLAG_KEYS = ("md", "d1", "mc", "c1", "pc")


def float_flags(df: DataFrame, cols: list[str]) -> dict[str, dict[str, int]]:
    """C3's column-wide flags for every float column from one aggregate:
    a partial aggregate per task and one final row of five small integers
    per column. That row is all that reaches the driver."""
    names = {c: f"__f{i}" for i, c in enumerate(cols)}
    row = df.agg(*[e for c in cols for e in N.float_flags(F.col(_q(c)), names[c])]).first()
    return {c: {k: int(row[f"{p}__{k}"] or 0) for k in FLAG_KEYS} for c, p in names.items()}


def merge_flags(a: dict[str, dict[str, int]], b: dict[str, dict[str, int]]) -> dict[str, dict[str, int]]:
    """The flags of two sets of rows together, from those of each: a greatest
    value by column and flag, so rows may come in any parts and order. Counts
    above two tell the rules nothing more, so a column's flags change at most
    seven times, however many rows are merged."""
    return {c: {k: min(2, max(a.get(c, {}).get(k, 0), b.get(c, {}).get(k, 0))) for k in FLAG_KEYS} for c in {**a, **b}}


def floats(df: DataFrame, cols: list[str], optional: int = 1, decimal: str | None = None,
           on_error: str = "fail", flags: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """C3. The column-wide flags come from one aggregate over the input, run
    by this call (keep an input that is costly to read again), or are given (declared in the spec, e.g. on a stream). They enter the plan
    as literals, so the optimizer folds away the rules that do not apply and
    the rows are transformed in one pass of narrow projections: no join, no
    shuffle of rows."""
    cols = present_columns(cols, df.columns, optional)
    if not cols:
        return df
    if flags is None:
        flags = float_flags(df, cols)
    lit = {c: {k: F.lit(int(flags[c].get(k, 0))) for k in FLAG_KEYS} for c in cols}
    # Each step is its own projection: the steps use their input several
    # times, and separate projections keep Catalyst from inlining them into
    # one exponentially large expression.
    out = df.withColumns({c: N.float_prepared(F.col(_q(c))) for c in cols})
    out = out.withColumns({c: N.float_step2(F.col(_q(c)), lit[c]["md"], lit[c]["d1"], lit[c]["mc"], lit[c]["c1"],
                                            decimal) for c in cols})
    out = out.withColumns({c: N.float_step3(F.col(_q(c)), lit[c]["pc"]) for c in cols})
    out = out.withColumns({c: N.float_step4(F.col(_q(c))) for c in cols})
    if on_error == "quarantine":
        out = _with_errors(out, {c: N.float_fails(F.col(_q(c))) for c in cols})
    out = out.withColumns({c: N.float_cast(F.col(_q(c)), _policy(on_error)) for c in cols})
    keep = df.columns + ([ERRORS] if on_error == "quarantine" and ERRORS not in df.columns else [])
    return out.select(*[_q(c) for c in keep])


# Class tag -> standardiser, in the fixed order the pipeline applies them.
CLASS_ORDER = ("date_cols", "float_cols", "nif_cols", "str_cols", "int_cols", "n_client_cols")


def transform(df: DataFrame, tag: str, spec: dict, optional: int | None = None,
              on_error: str = "fail", flags: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Dispatch one class tag of a ``data_types`` spec to its standardiser.
    ``contact_cols`` is declared but passes through unchanged."""
    types = spec
    opt = types.get("optional", 0) if optional is None else optional
    if tag not in types or not types[tag]:
        return df
    value = types[tag]
    if tag == "date_cols":
        return dates(df, value, opt, on_error)
    cols = split_list(value)
    if tag == "float_cols":
        return floats(df, cols, opt, types.get("decimal"), on_error, flags)
    if tag == "nif_cols":
        return tax_ids(df, cols, opt)
    if tag == "str_cols":
        return strings(df, cols, opt)
    if tag in ("int_cols", "n_client_cols"):
        return ints(df, cols, opt, on_error)
    return df
