"""Relational operators that replace the reference's SQL-text templating
(B7, E1, E2, E4-E7). Each is a plain DataFrame transformation or a value for
``spark.sql(text, args=...)``; no SQL text is spliced."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D

JOIN_TYPES = {
    "inner": "inner", "left": "left", "left outer": "left", "right": "right", "right outer": "right",
    "full": "full", "full outer": "full", "outer": "full", "semi": "left_semi", "left semi": "left_semi",
    "anti": "left_anti", "left anti": "left_anti",
}


def project_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """The needed columns of an auxiliary source, de-duplicated. A
    hash aggregate with map-side combine: duplicates collapse before the
    shuffle, so a value holding a third of the rows costs one row per task."""
    return df.select(*cols).dropDuplicates()


#: A universe is broadcast on request only if it is measured not to be larger.
UNIVERSE_BYTES = 256 << 20


def _bytes_of(df: DataFrame) -> int:
    """Size of a table's rows as text, from one aggregate."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("b")).first()
    return row["b"] or 0


def _place_of(name: str, columns: list[str]) -> int:
    """A column's place by its exact name, else by its name in any case if that tells one."""
    if name in columns:
        return columns.index(name)
    found = [i for i, c in enumerate(columns) if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"key {name!r} names {len(found)} of the columns {columns}")
    return found[0]


def restrict_to_universe(main: DataFrame, universe: DataFrame | None, join_on: list[str] | None = None,
                         how: str = "inner", broadcast_universe: bool = False) -> DataFrame:
    """Join the main table to a universe of entities on ``'left:right'``
    key pairs with any join type; no universe -> the main table unchanged.

    The strategy is left to the optimizer: AQE turns the sort-merge join into
    a broadcast join at run time when the universe is measured small, and
    splits skewed key partitions of the main table. AQE can split the main
    side only for inner, left, semi and anti joins, so right and full joins
    are rewritten as that join plus the universe rows no main row matches
    (an anti join against the main table's distinct keys, which are combined
    map-side first): a key holding a third of the main table stays
    splittable. Columns have names of their own while they are joined, so
    tables that share column names take the same way.
    ``broadcast_universe=True`` measures the universe and broadcasts it up to
    ``UNIVERSE_BYTES``; a larger one is joined as without the flag."""
    if universe is None or not join_on:
        return main
    kind = JOIN_TYPES.get(how.lower().replace("_", " ").strip())
    if kind is None:
        raise ValueError(f"unknown join type {how!r}")
    pairs = [tuple(k.strip() for k in p.split(":")) for p in join_on]
    m = main.toDF(*[f"__m{i}" for i in range(len(main.columns))])
    u = universe.toDF(*[f"__u{i}" for i in range(len(universe.columns))])
    left = [f"__m{_place_of(a, main.columns)}" for a, _ in pairs]
    right = [f"__u{_place_of(b, universe.columns)}" for _, b in pairs]
    if broadcast_universe and _bytes_of(u) <= UNIVERSE_BYTES:
        u = F.broadcast(u)
    same = reduce(lambda x, y: x & y, [F.col(a) == F.col(b) for a, b in zip(left, right)])
    if kind in ("left_semi", "left_anti"):
        return m.join(u, same, kind).toDF(*main.columns)
    out = m.join(u, same, {"right": "inner", "full": "left"}.get(kind, kind))
    if kind in ("right", "full"):
        lonely = u.join(m.select(*left).dropDuplicates(), same, "left_anti")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in m.schema]
        out = out.unionByName(lonely.select(*empty, *u.columns))
    return out.toDF(*main.columns, *universe.columns)


def group_by_date_part(df: DataFrame, ts: str, date_part: str, *aggs: Column,
                       name: str = "date_part") -> DataFrame:
    """Group by MONTH / WEEK / DAY / DOY of a timestamp."""
    return df.groupBy(D.date_part(date_part, ts).alias(name)).agg(*aggs)


def look_back(df: DataFrame, ts: str, anchor: Column | _dt.datetime, interval_dif: str, interval_t: int,
              date_part: str | None = None, include_anchor: bool = False) -> DataFrame:
    """Rows in ``[anchor - 'n unit', anchor)``. Month steps clamp to the
    month end (31 Mar - 1 month = 29 Feb 2020). A literal anchor keeps the
    filter a plain range on the column, so it reaches the parquet scan."""
    a = F.lit(anchor) if isinstance(anchor, _dt.datetime) else anchor
    start = a - D.look_back_interval(interval_dif, interval_t, date_part)
    upper = F.col(ts) <= a if include_anchor else F.col(ts) < a
    return df.where((F.col(ts) >= start) & upper)


def time_params(time: dict) -> dict[str, str]:
    """``{'date_obj': run date, tag: {'format': strftime, 'ref'?: anchor}}``
    -> ``{tag: formatted value}`` for ``spark.sql(text, args=...)``."""
    if "date_obj" not in time or not isinstance(time["date_obj"], _dt.datetime):
        raise ValueError("time parameters need a datetime 'date_obj'")
    when = time["date_obj"]
    out = {}
    for tag, p in time.items():
        if tag == "date_obj":
            continue
        d = D.anchor_python(when, p["ref"]) if "ref" in p else when
        out[tag] = d.strftime(p["format"])
    return out


def substitute_values(values: dict) -> dict:
    """E5: named values for ``spark.sql(text, args=...)``. Use ``:name`` for
    values and ``IDENTIFIER(:name)`` for table or column names."""
    return dict(values)
