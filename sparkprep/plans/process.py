"""standardise a table from a declared spec, and process one
configured source end to end (freshness -> input -> standardise -> write).

The input is read lazily. Jobs that run before the snapshot is written: the
parsed input, written once if the spec has float or masked columns; one
aggregate for the flags of all float columns; the dictionary append of masking;
the candidate rows of the dirty-file chain."""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import lines as L
from ..operators import mask as M
from ..operators import names as NM
from ..operators import standardize as S
from ..session import list_folder, materialize
from ..sources import delimited as DL
from ..sources import headers as H
from ..sources import raw_lines as RL
from ..sources import snapshots as SN

log = logging.getLogger(__name__)


def standardize_table(df: DataFrame, data_types: dict, mask_data: dict | None = None,
                      on_error: str = "fail", keep_input: bool = False, flags: dict | None = None) -> DataFrame:
    """wildcards -> coverage warnings -> dates, floats, tax ids, strings,
    ints, client numbers -> mask -> names. A column listed under two classes
    is transformed twice, as in the reference.

    Float flags, dictionaries and the output each read the input. With
    ``keep_input`` an input that is costly to read again (parsed text, a join)
    is written once to the shared folder, and each reads the columns it needs.
    ``flags`` of the float columns may be given, as a stream that has seen more
    rows than these gives them."""
    if keep_input and (data_types.get("float_cols") or mask_data):
        df = materialize(df)
    spec = NM.expand_wildcards(data_types, df.columns)
    declared: dict[str, int] = {}
    for c, _ in NM.declared_classes(spec):
        declared[c] = declared.get(c, 0) + 1
    for c in df.columns:
        if c not in declared:
            log.warning("column %s has no declared class", c)
    for c, n in declared.items():
        if n > 1:
            log.warning("column %s is declared %d times", c, n)
    for tag in S.CLASS_ORDER:
        df = S.transform(df, tag, spec, on_error=on_error, flags=flags)
    if mask_data:
        df = M.mask_columns(df, mask_data["references_path"], mask_data["mask_cols"])
    if_needed = spec.get("standardize_cols_names", True)
    names = spec.get("names")
    new_names = NM.split_list(names) if names else None
    if S.ERRORS in df.columns:
        data = [c for c in df.columns if c != S.ERRORS]
        renamed = NM.standardize_names(df.select(*[f"`{c}`" for c in data]), new_names, if_needed).columns
        return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(data, renamed)], S.ERRORS)
    return NM.standardize_names(df, new_names, if_needed)


@dataclass
class RunResult:
    """``counts`` of a written run: ``rows`` in the snapshot, ``rejected`` rows
    beside it, ``long_rows`` that the reader left out, and under ``failed`` the
    values by column that got their class's sentinel. All are counted by the jobs
    that read and write the rows."""

    status: str            # 'written' or 'fresh'
    snapshot: str | None
    path: str
    data: DataFrame | None
    counts: dict = field(default_factory=dict)
    rejected: DataFrame | None = None


def _latest_input(spark: SparkSession, folder: str, prefix: str, limit: str | None = None) -> str:
    """Newest input named ``<prefix>...`` directly under ``folder`` (a file,
    or a directory of parts as Spark writes them), or the last one at or
    before ``limit`` in name order. One directory listing."""
    names = [n for n in list_folder(spark, folder) if n.startswith(prefix)]
    if limit is not None:
        names = [n for n in names if n <= f"{prefix}_{limit}_~"]
    if not names:
        raise FileNotFoundError(f"no input {prefix}* in {folder}")
    return f"{folder.rstrip('/')}/{names[-1]}"


def _query_args(spark: SparkSession, params: dict, when: _dt.datetime, date_part: str, save: dict, product: str) -> dict:
    """Named SQL parameters of one ``apply_on_...`` block, and the views it
    asks for:

    ``time`` (E1) and ``substitute_values`` (E5) give ``:<tag>``; ``time_groups``
    (E6) gives ``:date_part``; ``time_difference`` (E7) gives
    ``:interval_dif``, to be used as ``cast(:interval_dif as interval)``;
    ``insert_into`` (E3) makes a view of the newest snapshot of each auxiliary
    source, under its tag; ``select_universe`` (E4) makes a view
    ``select_universe`` of the main table joined to the universe."""
    from ..operators import relational as R
    from . import script as SC

    args = dict(R.substitute_values(params.get("substitute_values") or {}))
    if params.get("time"):
        args.update(R.time_params({**params["time"], "date_obj": when}))
    groups = dict(params.get("time_groups") or {})
    if groups:
        unit = (date_part or groups.get("date_part") or "").upper()
        if unit not in D.DATE_PARTS:
            raise ValueError(f"date part must be one of {D.DATE_PARTS}, got {unit!r}")
        args["date_part"] = groups["date_part"] = unit
    if params.get("time_difference"):
        dif = params["time_difference"]
        unit, n = dif["interval_dif"], int(dif["interval_t"])
        if unit == "date_part":
            unit, n = {"MONTH": ("month", n), "WEEK": ("day", 7 * n)}.get(groups["date_part"], ("day", n))
        args["interval_dif"] = f"{n} {unit}"
    for tag, aux in (params.get("insert_into") or {}).items():
        name = aux.get("clean_source") or aux.get("prep_source")
        if not name:
            raise ValueError(f"insert_into {tag}: name a clean_source or prep_source")
        folder = SN.snapshot_path(aux.get("path", save["path"]), aux.get("tag", name), aux.get("product", product))
        declared = aux.get("create_table") or {}
        SC.register_aux(SN.read_latest(spark, folder), tag, NM.split_list(aux["cols_needed"]),
                        NM.split_list(declared["queries_cols_name"]) if declared else None,
                        NM.split_list(declared["queries_cols_type"]) if declared else None)
    if params.get("select_universe"):
        u = params["select_universe"]
        how = u["type_join"].lower().replace(" join", "").strip()
        R.restrict_to_universe(spark.table(u["main_table"]), spark.table(u["selected_universe_table"]), u["join_on"],
                               how).createOrReplaceTempView("select_universe")
    return args


def _query_input(spark: SparkSession, load: dict, manipulation: dict, types: dict, when: _dt.datetime,
                 date_part: str, save: dict, product: str) -> DataFrame:
    """The query input kind: Spark SQL over the session's catalog (the
    warehouse a Spark deployment reads). ``query`` is one text, or a list of
    ``{'view': name, 'sql': text}`` steps (E8) of which the last is the
    result; ``query_file`` names a file with the text. ``apply_on_<i>``
    parameters hold for step i, ``apply_on_all`` for every step; parameters
    beside them count as ``apply_on_all``. A script of several statements
    ends with the view named ``result_view``. Columns are named from the spec."""
    from . import script as SC

    names = NM.split_list(types["names"]) if types.get("names") else None
    sql = load.get("query")
    if sql is None:
        with open(load["query_file"], encoding="utf-8") as f:
            sql = f.read()
    steps = sql if isinstance(sql, list) else [{"view": "", "sql": sql}]
    blocks = {k: v or {} for k, v in manipulation.items() if k.startswith("apply_on_")}
    own = {k: v for k, v in manipulation.items() if k not in blocks}
    common = {**own, **blocks.get("apply_on_all", {})}
    ready = []
    for i, step in enumerate(steps, 1):
        params = {**common, **blocks.get(f"apply_on_{i}", {})}
        if load.get("result_view"):
            args = _query_args(spark, params, when, date_part, save, product)
            return SC.run_sql_script(spark, step["sql"], load["result_view"], names, args)
        ready.append((step, params))
    df = None
    for i, (step, params) in enumerate(ready, 1):
        # A step's views may build on the steps before it.
        args = _query_args(spark, params, when, date_part, save, product)
        df = SC.run_script(spark, [SC.Step(step["view"], step["sql"], args)], names if i == len(ready) else None)
    return df


def _flat_types(types: dict, multilevel: bool) -> dict:
    """Column lists as comma-separated trimmed text. With a two-row header a
    class may be grouped by micro tag; its columns then begin with the tag."""
    out = dict(types)
    for key in (*NM.CLASS_KEYS, "macro_tags_names", "micro_tags_names"):
        value = out.get(key)
        if value is None:
            continue
        if key == "date_cols":
            groups = {"": value} if "cols" in value else value
            merged: dict = {"cols": []}
            for tag, group in groups.items():
                lead = f"{tag}_" if tag else ""
                cols = NM.split_list(group["cols"] or "")
                merged["cols"] += [lead + c for c in cols]
                merged.update({lead + k if k in cols else k: v for k, v in group.items() if k != "cols"})
            out[key] = {**merged, "cols": ",".join(merged["cols"])}
        elif isinstance(value, dict):
            if not multilevel:
                raise ValueError(f"{key} is grouped by micro tag, but the source has no two-row header")
            out[key] = ",".join(f"{tag}_{c}" for tag, cols in value.items() for c in NM.split_list(cols or ""))
        else:
            out[key] = ",".join(NM.split_list(value))
    return out


def process_source(spark: SparkSession, spec: dict, src_time: str = "", file_path: str = "",
                   now: _dt.datetime | None = None, product: str = "master", date_part: str = "",
                   test: bool = False, data_folder_tests: str | None = None) -> RunResult:
    """F2. ``spec`` keys: ``raw_source`` {load_parameters, type}, ``data_types``,
    ``mask_data``, ``query_manipulation``, ``processed_source``
    {save_parameters}, ``conf_file`` {refresh_rate 'unit,rate'}, ``on_error``
    ('fail', 'sentinel' or 'quarantine').

    Freshness: with no explicit time or input file, the run is skipped while
    the last snapshot is younger than the refresh rate. The input is the
    explicit file, else the newest file of the input folder (or the last one
    at or before ``src_time``). With ``on_error='quarantine'`` rows with a value
    that failed are kept beside the snapshot (``RunResult.rejected``), not in it.
    ``test=True`` writes under
    ``data_folder_tests`` and applies the spec's ``tests_params`` overrides
    (``standardize_cols_names``)."""
    if src_time:
        SN.validate_tag(src_time)
        when, date_tag = _dt.datetime.strptime(src_time, SN.TAG_FORMAT), src_time
    else:
        when = now or _dt.datetime.now()
        date_tag = when.strftime(SN.TAG_FORMAT)
    save = dict(spec["processed_source"]["save_parameters"])
    if test:
        if not data_folder_tests:
            raise ValueError("test runs need data_folder_tests")
        save["path"] = data_folder_tests
    out_path = SN.snapshot_path(save["path"], save["tag"], product, date_part)

    refresh = spec.get("conf_file", {}).get("refresh_rate")
    unit, rate = (refresh.split(",")[0].strip(), int(refresh.split(",")[1])) if refresh else (None, 0)
    if not src_time and not file_path:
        made = SN.snapshot_names(spark, out_path)
        last = made[-1] if made else None
        if last is not None and unit is not None:
            age_ok = spark.range(1).select(
                D.is_stale(F.to_timestamp(F.lit(last), D.OUT_SPARK), F.lit(when), unit, rate).alias("s")
            ).collect()[0]["s"]
            if not age_ok:
                log.info("source %s is fresh (last snapshot %s)", save["tag"], last)
                return RunResult("fresh", last, out_path, None)

    load = spec["raw_source"]["load_parameters"]
    kind = spec["raw_source"].get("type", {})
    multilevel = bool(load.get("multilevel"))
    types = _flat_types(spec["data_types"], multilevel)
    read = Observation()
    on_error = spec.get("on_error", "fail")
    overrides = spec.get("tests_params") or {}
    if test and overrides.get("standardize_cols_names") is not None:
        types["standardize_cols_names"] = bool(overrides["standardize_cols_names"])
    counted = False
    if "quality" in kind:
        q = kind["quality"]
        header = NM.split_list(types["names"])
        line_spec = L.LineSpec(header=header, delimiter=load["delimiter"], quote=load.get("special_char", '"'),
                               id_pos=q["id_position"], name_pos=q["name_position"], email_pos=q["email_position"],
                               phone_pos=q["phone_position"],
                               content_after_name=(q.get("possible_content_after_name") or "").split(","),
                               max_cells=q.get("max_cells", 26))
        src = file_path or f"{load['path'].rstrip('/')}/{load['file_name']}.{load['file_type']}"
        lines, _ = RL.read_ordered_lines(spark, src, load.get("encoding", "utf-8"))
        row_errors = q.get("on_error", "fail")
        df = L.lines_to_table(lines, line_spec, on_error=row_errors)
        if row_errors != "fail":
            types["names"] = ",".join(header + ["_extra"])
    elif kind.get("specifics") == "query":
        df = _query_input(spark, load, spec.get("query_manipulation") or {}, types, when, date_part, save, product)
    else:
        src = file_path or _latest_input(spark, load["path"], load["file_name"], src_time or None)
        cells = {"delimiter": load.get("delimiter", ","), "quote": load.get("special_char", '"'),
                 "encoding": load.get("encoding", "utf-8")}
        if multilevel:
            df = H.read_two_row_header(spark, src, NM.split_list(types["macro_tags_names"]),
                                       NM.split_list(types["micro_tags_names"]), types.get("duplicated_macro_tag"),
                                       multi_line=bool(load.get("multi_line")), long_rows=load.get("long_rows", "drop"),
                                       counts=read, **cells)
        else:
            names = NM.split_list(types["names"]) if load.get("change_col_names") == "yes" else None
            df = DL.read_delimited(spark, src, load.get("header_row", 0), names=names,
                                   multi_line=bool(load.get("multi_line")), long_rows=load.get("long_rows", "drop"),
                                   counts=read, **cells)
        counted = load.get("long_rows", "drop") == "drop"
        df = H.drop_unnamed(df)

    raw_columns = df.columns
    # Sentinels are counted by the same marks that tell rejected rows.
    marked = on_error in ("sentinel", "quarantine")
    df = standardize_table(df, types, spec.get("mask_data"), "quarantine" if marked else on_error, keep_input=True)
    figures, how = {}, {}
    if marked and S.ERRORS in df.columns:
        spec_cols = NM.expand_wildcards(types, raw_columns)
        figures = {f"failed {c}": F.count_if(F.array_contains(S.ERRORS, c)) for c, tag in NM.declared_classes(spec_cols)
                   if tag in ("date_cols", "float_cols", "int_cols", "n_client_cols") and c in raw_columns}
        how = {"rejected": F.size(S.ERRORS) > 0, "reasons": S.ERRORS} if on_error == "quarantine" else {"hidden": S.ERRORS}
    file_type, delimiter = save.get("file_type", "parquet"), save.get("delimiter", ",")
    SN.write_snapshot(df, save["path"], save["tag"], date_tag, product, date_part, file_type, delimiter, figures=figures, **how)
    seen = SN.commit_of(spark, out_path, date_tag)["figures"]
    counts = {"rows": seen["rows"], "rejected": seen["rejected"], "long_rows": read.get["long_rows"] if counted else 0,
              "failed": {k.removeprefix("failed "): n for k, n in seen.items() if k.startswith("failed ")}}
    return RunResult("written", date_tag, out_path, SN.read_snapshot(spark, out_path, date_tag), counts,
                     SN.read_rejected(spark, out_path, date_tag))
