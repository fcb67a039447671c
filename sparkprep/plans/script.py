"""SQL scripts as one lazy plan.

The reference concatenates SQL files, edits ``[tag]`` markers and runs the
statements on one database cursor. Here a script is an ordered list of named
steps; each step is a ``spark.sql`` query with named parameters whose result
becomes a temp view for the next step. Nothing runs until the caller acts
on the returned DataFrame, so Catalyst optimises the whole script as one
plan (filters of the last step reach the first step's scans)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Step:
    view: str
    sql: str
    args: dict = field(default_factory=dict)


def run_script(spark: SparkSession, steps: list[Step | tuple], final_columns: list[str] | None = None,
               args: dict | None = None) -> DataFrame:
    """Run ``steps`` in order; step *i* gets its own ``args`` merged over
    the script-wide ``args`` (``apply_on_i`` over ``apply_on_all``). The last
    step's rows are returned under ``final_columns``."""
    if not steps:
        raise ValueError("empty script")
    base = dict(args or {})
    df = None
    for s in steps:
        s = s if isinstance(s, Step) else Step(*s)
        merged = {**base, **s.args}
        used = {k: v for k, v in merged.items() if f":{k}" in s.sql}
        df = spark.sql(s.sql, args=used) if used else spark.sql(s.sql)
        if s.view:
            df.createOrReplaceTempView(s.view)
    if final_columns:
        if len(final_columns) != len(df.columns):
            raise ValueError(f"{len(final_columns)} names for {len(df.columns)} columns")
        df = df.toDF(*final_columns)
    return df


def run_sql_script(spark: SparkSession, script: str, result_view: str, final_columns: list[str] | None = None,
                   args: dict | None = None) -> DataFrame:
    """E8 for script text: ``;``-separated Spark SQL statements run as one
    SQL script (``BEGIN ... END``, Spark's own statement handling) with
    named parameters. The statements define temporary views, the last one
    ``result_view``; its rows are returned lazily under ``final_columns``.

    The script must end with a view, not a bare SELECT: the script engine
    collects the rows of a final query to the driver, which is refused here."""
    body = script.strip().rstrip(";")
    if not body.upper().startswith("BEGIN"):
        body = f"BEGIN\n{body};\nEND"
    ran = spark.sql(body, args=args) if args else spark.sql(body)
    if ran.columns:
        raise ValueError("the script ends with a query; end it with CREATE TEMPORARY VIEW "
                         f"{result_view} AS ... so the result stays distributed")
    df = spark.table(result_view)
    if final_columns:
        if len(final_columns) != len(df.columns):
            raise ValueError(f"{len(final_columns)} names for {len(df.columns)} columns")
        df = df.toDF(*final_columns)
    return df


def register_aux(df: DataFrame, view: str, columns: list[str] | None = None,
                 names: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Expose an auxiliary source to SQL: needed columns, de-duplicated,
    optionally renamed and cast to declared types (reference defect 12
    fixed: the declared schema applies to every auxiliary source)."""
    if columns:
        df = df.select(*columns)
    df = df.dropDuplicates()
    if names or types:
        names = names or df.columns
        types = types or [None] * len(names)
        if len(names) != len(df.columns) or len(types) != len(names):
            raise ValueError("declared names/types must match the selected columns")
        df = df.select(*[(F.col(f"`{c}`").cast(t) if t else F.col(f"`{c}`")).alias(n)
                         for c, n, t in zip(df.columns, names, types)])
    df.createOrReplaceTempView(view)
    return df
