"""Versioned outputs: every run writes a snapshot ``YYYYmmdd_HHMMSS`` of a
table (A6); readers resolve "all", "latest", "on a date", "as of" and
named sources (A7-A11). A12's freshness gate is ``stale_sources``.

Layout of ``<root>/<product>/<tag>[/<tag>_<part>]``:

* ``snapshot=<YYYYmmdd_HHMMSS>/<run>/``: the rows, as one run wrote them;
* ``rejected=<YYYYmmdd_HHMMSS>/<run>/``: rows the run kept apart, if any;
* ``_commits/<YYYYmmdd_HHMMSS>.json``: the commit: which run counts, its format
  and schema, and its figures;
* ``_staging/<run>/``: what a run is still writing, or left when it failed.

A snapshot is published in two phases. The rows are written to the staging
folder and renamed into place as a whole, then the commit is written beside its
place and renamed over it. Only the commit makes a snapshot: a run that fails
before leaves the earlier one of that name readable, or none. A re-run has a
folder of its own, so it neither mixes with nor deletes what readers have open;
``vacuum_snapshots`` removes what no commit names.

A snapshot is chosen by its commit's name, from one directory listing, and only
its folder is opened, with the schema of the commit: no job looks at files to
find it, text snapshots come back with the types they were written with, and
earlier and later snapshots (and the folders of parts beside them) don't matter."""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..session import list_folder, modified, read_file, remove_folder, rename_folder, replace_file

SNAPSHOT = "snapshot"
REJECTED = "rejected"
TAG_FORMAT = "%Y%m%d_%H%M%S"
COMMITS = "_commits"
STAGING = "_staging"


def validate_tag(date_tag: str, fmt: str = TAG_FORMAT) -> str:
    try:
        _dt.datetime.strptime(date_tag, fmt)
    except ValueError as e:
        raise ValueError(f"snapshot tag must look like {fmt}: {date_tag!r}") from e
    return date_tag


def snapshot_path(root: str, tag: str, product: str = "master", part: str = "") -> str:
    base = f"{root.rstrip('/')}/{product}/{tag}"
    return f"{base}/{tag}_{part}" if part else base


def write_snapshot(df: DataFrame, root: str, tag: str, date_tag: str, product: str = "master",
                   part: str = "", file_type: str = "parquet", delimiter: str = ",",
                   rejected: Column | None = None, reasons: str | None = None,
                   hidden: str | None = None, figures: dict[str, Column] | None = None) -> str:
    """Write ``df`` as snapshot ``date_tag`` of ``tag``. A re-run replaces the
    snapshot by its own rows, also when it has none, once it has written all of
    them. CSV is written with a header and no BOM.

    Rows for which ``rejected`` is true are kept apart, for ``read_rejected``;
    both kinds come from one pass over ``df``, as partitions of one write. The
    column ``reasons`` is for rejected rows only; readers of the snapshot don't
    see it. A column ``hidden`` is not written; ``figures`` may use it.
    ``figures`` are further aggregates over all rows. They are observed during
    that pass, as are the row counts, and kept in the commit (``commit_of``)."""
    validate_tag(date_tag)
    path = snapshot_path(root, tag, product, part)
    bad = F.lit(False) if rejected is None else F.coalesce(rejected, F.lit(False))
    seen = Observation()
    out = df.drop(SNAPSHOT).withColumn("__rejected", bad)
    out = out.observe(seen, F.count_if(~F.col("__rejected")).alias("rows"), F.count_if("__rejected").alias("rejected"),
                      *[F.coalesce(c, F.lit(0)).alias(n) for n, c in (figures or {}).items()])
    if reasons and file_type == "csv":
        out = out.withColumn(reasons, F.array_join(reasons, ","))
    out = out.drop(hidden) if hidden else out
    schema = out.drop("__rejected").schema.jsonValue()
    parted = [] if rejected is None else ["__rejected"]
    out = out if parted else out.drop("__rejected")
    spark = df.sparkSession
    staging = _stage(spark, path, lambda place: _writer(out, file_type, delimiter, parted).save(place))
    run, counts = staging.rsplit("/", 1)[1], seen.get
    kept, apart = (f"{staging}/__rejected=false", f"{staging}/__rejected=true") if parted else (staging, None)
    commit = {"run": run, "format": file_type, "delimiter": delimiter, "schema": schema, "reasons": reasons, "figures": counts}
    _publish(spark, path, date_tag, commit, kept, apart)
    if parted:
        remove_folder(spark, staging)
    return path


def write_snapshots_by(df: DataFrame, path: str, snapshot: Column, file_type: str = "parquet") -> str:
    """Write many snapshots at once, named by a column expression (used to
    backfill history). Rows are clustered by snapshot so each snapshot is
    written by few tasks, not by every task; the ``rebalance`` hint lets AQE
    split a snapshot holding a large share of the rows over several tasks
    and merge small ones, instead of one task per snapshot. All rows are
    written before the first snapshot is published."""
    out = df.withColumn(SNAPSHOT, snapshot).hint("rebalance", SNAPSHOT)
    spark, schema = df.sparkSession, df.drop(SNAPSHOT).schema.jsonValue()
    staging = _stage(spark, path, lambda place: _writer(out, file_type, ",", [SNAPSHOT]).save(place))
    run = staging.rsplit("/", 1)[1]
    mark = f"{SNAPSHOT}="
    for folder in list_folder(spark, staging):
        if folder.startswith(mark):
            commit = {"run": run, "format": file_type, "delimiter": ",", "schema": schema}
            _publish(spark, path, folder[len(mark):], commit, f"{staging}/{folder}", None)
    remove_folder(spark, staging)
    return path


def _writer(df: DataFrame, file_type: str, delimiter: str, parted: list[str]):
    w = df.write.mode("error").format(file_type)
    if file_type == "csv":
        w = w.options(header=True, sep=delimiter, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return w.partitionBy(*parted) if parted else w


def _stage(spark: SparkSession, path: str, write) -> str:
    """Runs ``write`` on a new staging folder, which goes if the write fails."""
    staging = f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    try:
        write(staging)
    except BaseException:
        remove_folder(spark, staging)
        raise
    return staging


def _publish(spark: SparkSession, path: str, name: str, commit: dict, kept: str, apart: str | None) -> None:
    """Renames the staged folders into place, then puts the commit there. A
    staged folder that isn't there had no rows."""
    for kind, staged in ((SNAPSHOT, kept), (REJECTED, apart)):
        there = staged is not None and modified(spark, staged) is not None
        commit[f"{kind}_folder"] = f"{kind}={name}/{commit['run']}" if there else None
        if there:
            rename_folder(spark, staged, f"{path.rstrip('/')}/{kind}={name}/{commit['run']}")
    replace_file(spark, f"{path.rstrip('/')}/{COMMITS}/{name}.json", json.dumps({**commit, "written": time.time()}))


def commit_of(spark: SparkSession, path: str, name: str) -> dict:
    """The commit of a snapshot: format, schema, folders, and under ``figures``
    what its write counted (not of snapshots written many at once)."""
    text = read_file(spark, f"{path.rstrip('/')}/{COMMITS}/{name}.json")
    if text is None:
        raise FileNotFoundError(f"no snapshot {name} in {path}")
    return json.loads(text)


def adopt_snapshots(spark: SparkSession, path: str, file_type: str = "parquet", delimiter: str = ",") -> list[str]:
    """Commits folders ``snapshot=<name>`` that other tools (or this library
    before it had commits) have finished writing, as their ``_SUCCESS`` file
    tells. Gives their names; names that are committed already are left."""
    base, mark, made = path.rstrip("/"), f"{SNAPSHOT}=", []
    for folder in list_folder(spark, base):
        name = folder[len(mark):]
        if folder.startswith(mark) and name not in snapshot_names(spark, path) and "_SUCCESS" in list_folder(spark, f"{base}/{folder}"):
            options = dict(header=True, sep=delimiter, escape='"', inferSchema=True) if file_type == "csv" else {}
            schema = spark.read.format(file_type).options(**options).load(f"{base}/{folder}").schema
            commit = {"run": "", "format": file_type, "delimiter": delimiter, "schema": schema.jsonValue(), f"{SNAPSHOT}_folder": folder,
                      f"{REJECTED}_folder": None, "written": time.time()}
            replace_file(spark, f"{base}/{COMMITS}/{name}.json", json.dumps(commit))
            made.append(name)
    return made


def vacuum_snapshots(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Removes what no commit names: replaced runs and staging folders of
    failed ones, if last changed that long ago (a run that is being written, or
    was just replaced and is still read, is younger). Gives the folders."""
    base = path.rstrip("/")
    commits = {n: commit_of(spark, path, n) for n in snapshot_names(spark, path)}
    named = {c.get(f"{k}_folder") for c in commits.values() for k in (SNAPSHOT, REJECTED)}
    found = [f"{STAGING}/{run}" for run in list_folder(spark, f"{base}/{STAGING}")]
    for folder in list_folder(spark, base):
        if folder.startswith((f"{SNAPSHOT}=", f"{REJECTED}=")) and folder not in named:
            found += [f"{folder}/{run}" for run in list_folder(spark, f"{base}/{folder}")]
    old = [f for f in found if f not in named and modified(spark, f"{base}/{f}") <= time.time() - 3600 * older_than_hours]
    for f in old:
        remove_folder(spark, f"{base}/{f}")
    return old


def snapshot_names(spark: SparkSession, path: str) -> list[str]:
    """The names of a tag's committed snapshots in order, from one directory listing."""
    return [n.removesuffix(".json") for n in list_folder(spark, f"{path.rstrip('/')}/{COMMITS}")
            if n.endswith(".json") and not n.startswith(".")]


def list_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot names of a tag; no file is opened."""
    return spark.createDataFrame([(n,) for n in snapshot_names(spark, path)], f"{SNAPSHOT} string")


def _load(spark: SparkSession, path: str, commit: dict, folders: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(commit["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    r = spark.read.format(commit["format"]).schema(schema)
    if commit["format"] == "csv":
        # Cells may have line breaks; the files are as many as the write had tasks.
        # A cell without quotes and text is null, one with quotes is empty.
        r = r.options(header=True, nullValue="\u0000\u0001", emptyValue="", sep=commit["delimiter"], escape='"', multiLine=True,
                      ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return r.load([f"{path.rstrip('/')}/{f}" for f in folders])


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """A7 (data): every snapshot of a tag, with its ``snapshot`` column;
    columns that only some snapshots have are null in the others. The commits
    are read in one job; snapshots of one format and schema are one scan."""
    names = snapshot_names(spark, path)
    if not names:
        raise FileNotFoundError(f"no snapshot in {path}")
    texts = spark.read.text([f"{path.rstrip('/')}/{COMMITS}/{n}.json" for n in names], wholetext=True).collect()
    alike: dict[str, list[dict]] = {}
    for commit in (json.loads(t[0]) for t in texts):
        alike.setdefault(json.dumps([commit["format"], commit["delimiter"], commit["schema"], commit.get("reasons")]), []).append(commit)
    whole = None
    for group in sorted(alike.values(), key=lambda g: str(g[0]["schema"])):
        folders = [c[f"{SNAPSHOT}_folder"] for c in group if c[f"{SNAPSHOT}_folder"]]
        one = _load(spark, path, group[0], folders)
        hidden = _hidden(group[0])
        # Every file lies in <path>/snapshot=<name>/<run>, adopted ones without a run.
        name = F.regexp_extract(F.col("_metadata.file_path"), f"/{SNAPSHOT}=([^/]+)/(?:[^/]+/)?[^/]+$", 1) if folders else F.lit("")
        one = one.withColumn(SNAPSHOT, name).drop(*hidden)
        whole = one if whole is None else whole.unionByName(one, allowMissingColumns=True)
    rest = [c for c in whole.columns if c != SNAPSHOT]
    return whole.select(*[f"`{c}`" for c in rest], SNAPSHOT)


def read_snapshot(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One snapshot by its name: only its folder is opened."""
    commit = commit_of(spark, path, name)
    folder = commit[f"{SNAPSHOT}_folder"]
    rows = _load(spark, path, commit, [folder] if folder else [])
    return rows.drop(*_hidden(commit)).withColumn(SNAPSHOT, F.lit(name))


def _hidden(commit: dict) -> list[str]:
    return [commit["reasons"]] if commit.get("reasons") else []


def read_rejected(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows that the run of a snapshot kept apart, with their reasons."""
    commit = commit_of(spark, path, name)
    folder = commit[f"{REJECTED}_folder"]
    return _load(spark, path, commit, [folder] if folder else []).withColumn(SNAPSHOT, F.lit(name))


def _latest_of(spark, path: str, accept, what: str) -> DataFrame:
    names = [n for n in snapshot_names(spark, path) if accept(n)]
    if not names:
        raise FileNotFoundError(f"no snapshot {what} in {path}")
    return read_snapshot(spark, path, names[-1])


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The greatest snapshot name."""
    return _latest_of(spark, path, lambda n: True, "at all")


def read_on_date(spark: SparkSession, path: str, date: str) -> DataFrame:
    """The latest snapshot of a calendar day ``YYYYMMDD``."""
    validate_tag(date, "%Y%m%d")
    return _latest_of(spark, path, lambda n: n.startswith(date), f"on {date}")


def read_as_of(spark: SparkSession, path: str, limit: str, inclusive: bool = True) -> DataFrame:
    """A10: the last snapshot at (or, ``inclusive=False``, strictly before)
    ``limit``; none -> error (reference defect 14: no wrap to the newest)."""
    validate_tag(limit)
    if inclusive:
        return _latest_of(spark, path, lambda n: n <= limit, f"at or before {limit}")
    return _latest_of(spark, path, lambda n: n < limit, f"before {limit}")


def read_named(spark: SparkSession, catalog: dict, source: str, tags: list[str] | None = None,
               selection_mode: str = "recent", filter_date: str | None = None,
               root: str | None = None) -> DataFrame | tuple[DataFrame, ...]:
    """Read one or several tags of a configured source. ``catalog`` maps
    a source name to ``{'root', 'product', 'tags': [...]}``;
    mode ``recent`` -> A8, ``by_date`` -> A9. Several tags -> a tuple."""
    if source not in catalog:
        raise KeyError(f"unknown source {source!r}")
    spec = catalog[source]
    base = root or spec["root"]
    tags = tags or spec["tags"]
    out = []
    for t in tags:
        path = snapshot_path(base, t, spec.get("product", "master"), spec.get("part", ""))
        if selection_mode == "recent":
            out.append(read_latest(spark, path))
        elif selection_mode == "by_date":
            if not filter_date:
                raise ValueError("selection_mode 'by_date' needs filter_date")
            out.append(read_on_date(spark, path, filter_date))
        else:
            raise ValueError(f"unknown selection mode {selection_mode!r}")
    return out[0] if len(out) == 1 else tuple(out)


def stale_sources(last: DataFrame, now: Column | _dt.datetime, last_col: str = "last_snapshot",
                  unit_col: str = "unit", rate_col: str = "rate") -> DataFrame:
    """A12 as a table operator: one row per source with its last snapshot
    time, a unit (year/month/week/day/hour or null) and a rate; adds
    ``stale`` (more than ``rate`` whole units elapsed, or no unit)."""
    n = F.lit(now) if isinstance(now, _dt.datetime) else now
    last_ts = F.col(last_col)
    cases = F.when(F.col(unit_col).isNull(), F.lit(True))
    for u in D.FRESHNESS_UNITS:
        cases = cases.when(F.col(unit_col) == u, D.elapsed_units(last_ts, n, u) > F.col(rate_col))
    return last.withColumn("stale", cases.otherwise(F.raise_error(F.lit("invalid freshness unit")).cast("boolean")))
