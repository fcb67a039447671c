"""Column-name and spec operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import standardize_name

WILDCARD = "#all-cols-starts-with#"
# The spec keys that list columns of one class.
CLASS_KEYS = ["names", "n_client_cols", "str_cols", "int_cols", "nif_cols", "float_cols", "contact_cols",
              "date_cols"]


def standardize_names(df: DataFrame, new_names: list[str] | None = None, if_needed: bool = True) -> DataFrame:
    """B1: rename positionally to ``new_names`` (default: the current names),
    normalised by the name rule unless ``if_needed=False``. The names are
    trimmed first."""
    names = [n.strip() for n in (new_names if new_names is not None else df.columns)]
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    if if_needed:
        names = [standardize_name(n) for n in names]
    return df.toDF(*names)


def split_list(v) -> list[str]:
    """A column list of a spec: a list, or comma-separated text that may be
    wrapped over lines; names are trimmed, blank ones skipped."""
    items = v.split(",") if isinstance(v, str) else v
    return [c.strip() for c in items if c.strip()]


def _expanded(listed, columns: list[str]) -> tuple[list[str], dict[str, list[str]]]:
    """A class list with its wildcards resolved, and what each stood for."""
    listed = split_list(listed)
    found = {t: [c for c in columns if c.startswith(t.replace(f"_{WILDCARD}", ""))] for t in listed if WILDCARD in t}
    return [c for c in listed if c not in found] + [c for cs in found.values() for c in cs], found


def expand_wildcards(spec: dict, columns: list[str]) -> dict:
    """``prefix_#all-cols-starts-with#`` in a class list becomes every
    column starting with ``prefix``, placed after the plain names; a date
    format declared for the wildcard is copied to each expanded column."""
    out, columns = dict(spec), [c.strip() for c in columns]
    for key in CLASS_KEYS:
        if spec.get(key) is None:
            continue
        if key != "date_cols":
            out[key] = ",".join(_expanded(spec[key], columns)[0])
            continue
        cols, found = _expanded(spec[key]["cols"], columns)
        formats = {c: spec[key][t] for t, cs in found.items() if t in spec[key] for c in cs}
        own = {k: v for k, v in spec[key].items() if k not in found}
        out[key] = {**formats, **own, "cols": ",".join(cols)}
    return out


def declared_classes(spec: dict) -> list[tuple[str, str]]:
    """(column, class) pairs declared by a ``data_types`` spec."""
    pairs = []
    for key in CLASS_KEYS:
        if key == "names" or key not in spec or spec[key] is None:
            continue
        cols = split_list(spec[key]["cols"]) if key == "date_cols" else split_list(spec[key])
        pairs += [(c, key) for c in cols]
    return pairs


PARSED_CLASSES = ("date_cols", "float_cols", "int_cols", "n_client_cols")


def type_coverage(df: DataFrame, spec: dict) -> DataFrame:
    """B5 as data work: one row per column of the table or of the spec with
    its declared classes, a status (``ok``, ``undeclared``, ``multiple``,
    ``missing``) and, for columns present, ``n_rows``, ``n_null`` and
    ``n_unparsable`` (values the declared date/float/int standardiser
    rejects; 0 for classes that cannot fail). The parse check runs the
    standardisers in quarantine mode; all counts come from one aggregate
    (partial per task, one row per task shuffled). Declared float columns
    need their flags first, which is one more aggregate, run by this call."""
    from . import standardize as S

    pairs = declared_classes(spec)
    declared: dict[str, list[str]] = {}
    for c, k in pairs:
        declared.setdefault(c, []).append(k)
    names = list(dict.fromkeys(list(df.columns) + list(declared)))
    present = [c for c in names if c in df.columns]
    checked = df.select("*", *[F.col(f"`{c}`").isNull().alias(f"__isnull{i}") for i, c in enumerate(present)])
    parse_spec = {"optional": 1}
    for tag in PARSED_CLASSES:
        if tag not in spec or not spec[tag]:
            continue
        if tag == "date_cols":
            dp = dict(spec[tag])
            cols = [c for c in split_list(dp["cols"]) if c in df.columns]
            has_fmt = [c for c in cols if c in dp or any(k in dp for k in ("other_formats", "mix", "global_format"))]
            if has_fmt:
                parse_spec[tag] = {**dp, "cols": ",".join(has_fmt)}
        else:
            parse_spec[tag] = spec[tag]
    for tag in S.CLASS_ORDER:
        if tag in parse_spec:
            checked = S.transform(checked, tag, parse_spec, optional=1, on_error="quarantine")
    errors = F.col(S.ERRORS) if S.ERRORS in checked.columns else F.array().cast("array<string>")
    stats = checked.agg(
        F.count(F.lit(1)).alias("__rows"),
        F.array(*[F.count_if(f"__isnull{i}") for i in range(len(present))]).alias("__nulls"),
        F.array(*[F.count_if(F.array_contains(errors, c)) for c in present]).alias("__bad"))
    # The report rows are labelled with literals from the spec and filled
    # from the single aggregate row: no join at all.
    rows = []
    for c in names:
        i = present.index(c) if c in df.columns else -1
        classes = declared.get(c, [])
        status = ("missing" if i < 0 else "undeclared" if not classes
                  else "multiple" if len(classes) > 1 else "ok")
        null_n = F.lit(None).cast("bigint")
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(",".join(classes)).alias("classes"),
            F.lit(len(classes)).alias("n_classes"), F.lit(status).alias("status"),
            (F.col("__rows") if i >= 0 else null_n).alias("n_rows"),
            (F.col("__nulls")[i] if i >= 0 else null_n).alias("n_null"),
            (F.col("__bad")[i] if i >= 0 and classes else null_n).alias("n_unparsable")))
    return stats.select(F.inline(F.array(*rows)))
