"""A1: delimited text read as all-text columns, the way the reference's
reader behaves: configurable header row, delimiter, encoding and quote;
over-long rows are dropped, short rows padded with null; the usual NA
literals become null; duplicate header names get ``.1``, ``.2`` suffixes."""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .raw_lines import WIDE_CHARSETS, _charset, _scan, allow_charset, wide_lines
from .stitch import move, stitch

# Text read as missing (the reader's default NA literals).
NA_LITERALS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null"]
_OVERFLOW = "_overflow"
_NEVER = "\u0000\u0001"


def dedupe_names(names: list[str]) -> list[str]:
    """``a, a`` -> ``a, a.1`` (first keeps its name)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            cand = f"{n}.{seen[n]}"
            while cand in seen:
                seen[n] += 1
                cand = f"{n}.{seen[n]}"
            seen[cand] = 0
            out.append(cand)
        else:
            seen[n] = 0
            out.append(n)
    return out


def unnamed_blanks(names: list[str]) -> list[str]:
    """Blank header cells are called ``Unnamed: <i>``."""
    return [n if n.strip() else f"Unnamed: {i}" for i, n in enumerate(names)]


def _parse_header(line: str, delimiter: str, quote: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=delimiter, quotechar=quote or None))


def _opens(line: Column, delimiter: str, quote: str) -> Column:
    """Whether a quoted cell that begins on the line is open at its end. A cell
    is quoted if it begins with the quote; a doubled quote inside is one."""
    d, q = re.escape(delimiter), re.escape(quote)
    # Pairs never change which cells are closed; then closed quoted cells go.
    single = F.replace(line, F.lit(quote * 2), F.lit(""))
    rest = F.regexp_replace(single, f"(\\A|{d}){q}[^{q}]*{q}[^{d}]*", "$1")
    return F.contains(line, F.lit(quote)) & rest.rlike(f"(?:\\A|{d}){q}")


def _stays_open(line: Column, delimiter: str, quote: str) -> Column:
    """Whether a quoted cell is open at the line's end, if one is open at its begin."""
    d, q = re.escape(delimiter), re.escape(quote)
    single = F.replace(line, F.lit(quote * 2), F.lit(""))
    rest = F.regexp_replace(single, f"\\A[^{q}]*{q}[^{d}]*", "")
    return ~F.contains(single, F.lit(quote)) | _opens(rest, delimiter, quote)


def quoted_records(spark: SparkSession, path, encoding: str, delimiter: str, quote: str) -> DataFrame:
    """Records (file, __block, line_no, row_no, line) whose quoted cells may hold
    line breaks, read in parallel: ``stitch`` follows over all lines and splits of
    a file whether a quoted cell is open. LF and CRLF end a line; in a cell both
    come back as LF."""
    charset = _charset(encoding)
    raw = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    if charset not in ("utf-8", "us-ascii"):
        allow_charset(spark, charset)
        line = F.decode(line.cast("binary"), charset)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"),
                     F.monotonically_increasing_id().alias("__mid"), F.regexp_replace(line, "\r\\z", "").alias("line"))
    text = F.col("line")
    # States: outside of cells with quotes (a line begins a record), inside.
    moves = F.array(move(_opens(text, delimiter, quote).cast("int"), F.lit(True)),
                    move(_stays_open(text, delimiter, quote).cast("int"), F.lit(False)))
    pieces = raw.select("file", "__block", "__mid", text.cast("binary").alias("piece"), moves.alias("moves"),
                        (F.length(F.trim(text)) == 0).alias("blank"), F.lit(False).alias("void"))
    records, _ = stitch(pieces, 2, (0,), "a quote is not closed at the end of the file")
    return records.withColumn("line", F.col("record").cast("string")).drop("record")


def read_delimited(spark: SparkSession, path: str, header_row: int = 0, delimiter: str = ",",
                   encoding: str = "utf-8", quote: str = '"', names: list[str] | None = None,
                   na_values: list[str] | None = None, multi_line: bool = False,
                   long_rows: str = "drop", counts: Observation | None = None) -> DataFrame:
    """Read delimited text as strings. ``names`` replaces the header names
    (the header row is still skipped; as many names as header cells). Only the
    header lines reach the driver; rows are parsed on the executors.

    A doubled quote inside a quoted cell is one quote; a backslash is a
    character like others. Cells with line breaks need ``multi_line=True``;
    otherwise a row whose quote does not end on its line fails the job. Such
    files are read in parallel too (``quoted_records``), at the price of a scan
    that follows the quotes; only those in UTF-16 or UTF-32 are read by one task
    each. ``long_rows`` says what happens to rows
    with more cells than the header: 'drop' them (``counts`` observes how many,
    in the first job over the rows), 'fail', or 'keep' them with
    the rest of their line, from that cell on, in ``_extra`` (null for other rows)."""
    if long_rows not in ("drop", "fail", "keep"):
        raise ValueError("long_rows must be 'drop', 'fail' or 'keep'")
    charset = _charset(encoding)
    wide = charset in WIDE_CHARSETS
    if multi_line and wide and header_row:
        raise ValueError("multi_line in UTF-16 or UTF-32 needs the header in the first row")
    # Blank lines are skipped and do not count for ``header_row``. The header
    # comes from the first lines of a first input split, the way Spark's own
    # CSV reader finds a header: the limit reads no more than it needs.
    scan = records = None
    if wide:
        records, _ = wide_lines(spark, path, charset)
    elif multi_line and quote:
        records = quoted_records(spark, path, encoding, delimiter, quote)
    else:
        scan = _scan(spark, path, encoding, skip_blank=True)
    if records is not None:
        head = [r["line"] for r in records.where(F.col("row_no") == header_row).select("line").limit(1).collect()]
    else:
        head = [r["line"] for r in scan.where(F.col("__block") == 0).select("line").limit(header_row + 1).collect()][header_row:]
    if not head:
        raise ValueError(f"no header row {header_row} in {path}")
    header = unnamed_blanks(_parse_header(head[0], delimiter, quote))
    if names and len(names) != len(header):
        raise ValueError(f"{len(names)} names for {len(header)} header cells in {path}")
    cols = dedupe_names(names if names else header)
    n = len(cols)
    if multi_line and wide:
        # One task decodes and parses a file from its begin to its end.
        if long_rows == "keep":
            raise ValueError("long_rows='keep' isn't offered for multi_line in UTF-16 or UTF-32")
        allow_charset(spark, charset)
        rows = (spark.read.options(header=True, enforceSchema=True, multiLine=True, encoding=charset, **csv_options(delimiter, quote))
                .schema(_cells(cols)).csv(path))
        return finish_rows(rows, cols, na_values, long_rows, counts)
    if records is not None:
        lines = records.where(F.col("row_no") > header_row).select("line")
    elif header_row == 0:
        # Whole lines through the CSV source, which skips the header of each file.
        allow_charset(spark, charset)
        lines = spark.read.options(header=True, enforceSchema=True, encoding=charset, **csv_options("\u0000", "")) \
            .schema("line string").csv(path)
    else:
        # Only the first split of a file can hold its header.
        top = scan.where(F.col("__block") == 0)
        first = top.groupBy("file").agg(F.min("__mid").alias("__first"))
        top = top.join(first, "file").where(F.col("__mid") - F.col("__first") > header_row)
        lines = scan.where(F.col("__block") != 0).select("line").unionByName(top.select("line"))
    return parse_lines(lines, cols, delimiter, quote, na_values, long_rows, counts, whole=multi_line)


def _cells(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f"__c{i}", T.StringType()) for i in range(len(cols))] + [T.StructField(_OVERFLOW, T.StringType())])


def parse_lines(lines: DataFrame, cols: list[str], delimiter: str, quote: str, na_values: list[str] | None = None,
                long_rows: str = "drop", counts: Observation | None = None, whole: bool = False) -> DataFrame:
    """Rows of ``cols`` from a ``line`` column, by the rules of ``read_delimited``.
    ``whole`` lines are records already: their quoted cells may have line breaks."""
    line = F.col("line")
    if quote and not whole:
        line = F.when(_opens(line, delimiter, quote),
                      F.raise_error(F.concat(F.lit("a quote is not closed on its line (multi_line=True reads such cells): "),
                                             line)).cast("string")).otherwise(line)
    parsed = F.from_csv(line, _cells(cols).simpleString(), csv_options(delimiter, quote)).alias("r")
    rows = lines.select(parsed, F.col("line").alias("__line")).select("r.*", "__line") if long_rows == "keep" else \
        lines.select(parsed).select("r.*")
    return finish_rows(rows, cols, na_values, long_rows, counts, delimiter, quote)


def finish_rows(rows: DataFrame, cols: list[str], na_values: list[str] | None, long_rows: str, counts: Observation | None,
                delimiter: str = ",", quote: str = '"') -> DataFrame:
    """NA literals and rows with more cells than names."""
    n = len(cols)
    na = na_values if na_values is not None else NA_LITERALS
    out = [F.when(F.col(f"__c{i}").isin(na), F.lit(None)).otherwise(F.col(f"__c{i}")).alias(c) for i, c in enumerate(cols)]
    if long_rows == "keep":
        # What follows the declared cells on the line.
        d, q = re.escape(delimiter), re.escape(quote or "\u0000")
        cell = f"(?:{q}(?:[^{q}]|{q}{q})*{q}[^{d}]*|(?!{q})[^{d}]*)"
        rest = F.regexp_replace("__line", f"\\A{cell}(?:{d}{cell}){{{n - 1}}}{d}", "")
        return rows.select(*out, F.when(F.col(_OVERFLOW).isNotNull(), rest).alias("_extra"))
    if long_rows == "fail":
        guard = F.when(F.col(_OVERFLOW).isNotNull(), F.raise_error(F.lit(f"a row has more than {n} cells")).cast("boolean"))
        return rows.where(F.coalesce(guard, F.lit(True))).select(*out)
    if counts is not None:
        rows = rows.observe(counts, F.count_if(F.col(_OVERFLOW).isNotNull()).alias("long_rows"))
    return rows.where(F.col(_OVERFLOW).isNull()).select(*out)


def csv_options(delimiter: str, quote: str) -> dict[str, str]:
    """Cell rules of both CSV parsers (source and ``from_csv``): a quote inside
    a quoted cell is doubled, and no text but a blank cell is missing."""
    q = quote or "\u0000"
    return {"sep": delimiter, "quote": q, "escape": q, "nullValue": _NEVER, "emptyValue": "", "mode": "PERMISSIVE"}
