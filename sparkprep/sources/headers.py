"""A4 and A5: header clean-up on read tables."""

from __future__ import annotations

import re
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPARK_BLANK = re.compile(r"^_c\d+$")


def drop_unnamed(df: DataFrame) -> DataFrame:
    """A4: drop columns whose name contains 'unnamed' (any case) - the name a
    blank header cell gets - and Spark's own blank-header names ``_c<i>``."""
    drop = [c for c in df.columns if "unnamed" in c.lower() or _SPARK_BLANK.match(c)]
    return df.drop(*drop)


def flatten_multilevel_header(df: DataFrame, macro_tags: list[str], micro_tags: list[str],
                              duplicated_macro_tag: str | None = None, order_col: str = "line_no",
                              sub_header: list[str] | None = None) -> DataFrame:
    """A5: two header rows -> one. ``df``'s column names are the top header
    (blank cells named 'Unnamed: i'); its first row (smallest ``order_col``)
    holds the sub-headers unless ``sub_header`` is given. A named top header
    owns the columns up to the next named one. For each (macro, micro) pair
    the group whose header starts with ``macro`` is kept and renamed
    ``micro_<sub>``; with several matches and ``duplicated_macro_tag='year'``
    all are kept as ``micro_<sub>_<last run of >=4 digits>``, otherwise only
    the last match. The sub-header row is removed. Only that one row is
    brought to the driver."""
    if len(macro_tags) != len(micro_tags):
        raise ValueError("macro_tags and micro_tags must have the same length")
    cols = [c for c in df.columns if c != order_col]
    if sub_header is None:
        first = df.agg(F.min_by(F.struct(*[F.col(f"`{c}`").cast("string") for c in cols]), order_col).alias("r"),
                       F.min(order_col).alias("at")).first()
        if first["at"] is None:
            raise ValueError("no sub-header row")
        sub_header = ["" if v is None else v for v in first["r"]]
        df = df.where(F.col(order_col) > F.lit(first["at"]))
    # Each column belongs to the last named header at or left of it.
    owner = list(accumulate(cols, lambda left, c: left if c.startswith("Unnamed") else c))
    picked: list[tuple[str, str]] = []
    for macro, micro in zip(macro_tags, micro_tags):
        groups = [g for g in dict.fromkeys(owner) if g.startswith(macro) and not g.startswith("Unnamed")]
        every = duplicated_macro_tag is not None and len(groups) > 1
        for group in groups if every else groups[-1:]:
            tail = "_" + _year(group, duplicated_macro_tag) if every else ""
            picked += [(c, f"{micro}_{sub}{tail}") for c, o, sub in zip(cols, owner, sub_header) if o == group]
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in picked])


def _year(header: str, kind: str) -> str:
    """The last digit run of four or more, for the duplicate tag 'year'."""
    return next(reversed(re.findall(r"[0-9]{4,}", header)), "") if kind == "year" else ""


def read_two_row_header(spark, path: str, macro_tags: list[str], micro_tags: list[str],
                        duplicated_macro_tag: str | None = None, delimiter: str = ",", quote: str = '"',
                        encoding: str = "utf-8", multi_line: bool = False, long_rows: str = "drop", counts=None) -> DataFrame:
    """A5 straight from delimited files; the first two lines of the first file
    by name are the top and sub headers. Only those two lines reach the driver.
    The body is read by the rules of ``read_delimited``: blank lines are skipped,
    NA literals are null, over-long rows dropped (or failed), an open quote fails
    unless ``multi_line`` lets cells have line breaks."""
    from . import delimited as DL
    from .raw_lines import WIDE_CHARSETS, _charset, _scan, wide_lines

    if long_rows not in ("drop", "fail"):
        raise ValueError("long_rows must be 'drop' or 'fail' here")
    name = min(spark.read.text(path).inputFiles(), default=None)
    if name is None:
        raise ValueError(f"no file in {path}")
    name = unquote(name)  # Spark lists paths URL-encoded
    charset = _charset(encoding)
    # The file's name as rows have it.
    shown = spark.read.text(name).select(F.col("_metadata.file_path").alias("file")).first()
    in_first = F.col("file") == F.lit(shown["file"] if shown else "")
    if charset in WIDE_CHARSETS or (multi_line and quote):
        if multi_line and charset in WIDE_CHARSETS:
            raise ValueError("multi_line isn't offered for a two-row header in UTF-16 or UTF-32")
        rows = DL.quoted_records(spark, path, encoding, delimiter, quote) if multi_line else wide_lines(spark, path, charset)[0]
        rows = rows.where("row_no IS NOT NULL")
        head = [r["line"] for r in rows.where(in_first & (F.col("row_no") < 2)).orderBy("row_no").select("line").collect()]
        lines = rows.where(~in_first | (F.col("row_no") >= 2))
    else:
        # The first file is scanned by itself: the ids of its header lines hold for that scan.
        own = _scan(spark, name, encoding, skip_blank=True)
        top = own.where(F.col("__block") == 0).select("__mid", "line").limit(2).collect()
        head = [r["line"] for r in top]
        after = top[-1]["__mid"] if top else -1
        lines = own.where((F.col("__block") != 0) | (F.col("__mid") > after)).select("line").unionByName(
            _scan(spark, path, encoding, skip_blank=True).where(~in_first).select("line"))
    if len(head) < 2:
        raise ValueError("a two-row header needs two header lines")
    names = DL.unnamed_blanks(DL._parse_header(head[0], delimiter, quote))
    sub = DL._parse_header(head[1], delimiter, quote)
    body = DL.parse_lines(lines.select("line"), DL.dedupe_names(names), delimiter, quote, None, long_rows, counts, whole=multi_line)
    return flatten_multilevel_header(body, macro_tags, micro_tags, duplicated_macro_tag,
                                     sub_header=sub + [""] * (len(names) - len(sub)))
