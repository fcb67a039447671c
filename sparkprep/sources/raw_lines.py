"""A2: a text file as ordered lines ``(file, line_no, line)``.

Line numbers follow file order and are 0-based per file, computed without
moving lines: every input split knows its file and byte offset
(``_metadata.file_block_start``) and, inside a task, rows keep their order
(``monotonically_increasing_id`` is consecutive within a partition). An
aggregate counts lines per split; a window over those few rows per file gives
each split's first line number. The split table is keyed by two numbers and
has one row per split (a split ends where its file or its partition ends, so
there are at most files + partitions of them), 24 bytes each: a million splits
are 24 MB. That bound is why it can always be broadcast; lines never move."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stitch import file_bases, move, stitch

# The reference's default encoding name and its Java charset.
ENCODING_ALIASES = {"ansi": "windows-1252", "utf": "utf-8", "utf8": "utf-8", "utf-8-sig": "utf-8"}

# The charsets Spark's CSV source accepts without the legacy flag.
STANDARD_CHARSETS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}


def allow_charset(spark: SparkSession, charset: str) -> None:
    """Other Java charsets (windows-1252, ...) need the legacy charset flag."""
    if charset not in STANDARD_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def _charset(encoding: str | None) -> str:
    e = (encoding or "utf-8").lower()
    return ENCODING_ALIASES.get(e, e)


#: Charsets of more than one byte a character unit, and the units' bytes.
WIDE_CHARSETS = {"utf-16": 2, "utf-16be": 2, "utf-16le": 2, "utf-32": 4, "utf-32be": 4, "utf-32le": 4}

# Byte order marks, the longer first.
BYTE_ORDER_MARKS = [(b"\xff\xfe\x00\x00", "utf-32le"), (b"\x00\x00\xfe\xff", "utf-32be"), (b"\xff\xfe", "utf-16le"),
                    (b"\xfe\xff", "utf-16be"), (b"\xef\xbb\xbf", "utf-8")]


def wide_charset(spark: SparkSession, path, charset: str) -> str:
    """The charset with its byte order: as named, else as the byte order mark of
    the first file (by name) says, else little-endian."""
    if charset.endswith(("le", "be")):
        return charset
    name = min(spark.read.text(path).inputFiles(), default=None)
    head = b""
    if name is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
        head = bytes(b & 255 for b in (stream.read() for _ in range(4)) if b >= 0)
        stream.close()
    for mark, name in BYTE_ORDER_MARKS:
        if head.startswith(mark) and name.startswith(charset):
            return name
    return f"{charset}le"


def wide_lines(spark: SparkSession, path, charset: str) -> tuple[DataFrame, DataFrame]:
    """Lines (file, __block, line_no, row_no, line) of UTF-16 or UTF-32 files, and
    their split table, read in parallel.

    The files are cut at every byte 0A, whether it is a line feed's or lies within
    another character (U+0A05 or U+010A, for two); ``stitch`` follows the offset
    within a character over all pieces and splits of a file. In little-endian text
    a line feed is 0A at a character's begin with zeros after it, so a piece
    begins a line if it begins with them; in big-endian text the zeros end the
    piece before. LF and CRLF end a line. A byte order mark is not part of one."""
    name = wide_charset(spark, path, charset)
    unit, little = WIDE_CHARSETS[name], name.endswith("le")
    zeros = F.lit(bytearray(unit - 1))
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"),
                     F.monotonically_increasing_id().alias("__mid"), "value", F.col("value").cast("binary").alias("piece"))
    piece, size = F.col("piece"), F.octet_length("piece")
    # States: 0 at a line's begin (in little-endian text only a file's), 1 to
    # unit - 1 that many bytes into a character, unit between two characters, and
    # unit + 1 after a byte 0A at the begin of a little-endian character.
    last = F.substring(piece, -(unit - 1), unit - 1)
    moves = []
    for state in range(unit + 2 if little else unit + 1):
        offset = {0: 0, unit: 0, unit + 1: 1}.get(state, state)
        at = (size + offset) % unit  # of the byte 0A after the piece
        if little:
            after = F.when(at == 0, F.lit(unit + 1)).when(at == unit - 1, F.lit(unit)).otherwise(at + 1)
            begins = F.lit(state == 0) if state != unit + 1 else F.substring(piece, 1, unit - 1) == zeros
        else:
            after = F.when((at == unit - 1) & (last == zeros) & (size >= unit - 1), F.lit(0)).when(at == unit - 1, F.lit(unit)).otherwise(at + 1)
            begins = F.lit(state == 0)
        moves.append(move(after, begins))
    pieces = raw.select("file", "__block", "__mid", "piece", F.array(*moves).alias("moves"), F.col("value").rlike(_blank(unit, little)).alias("blank"),
                        (piece == zeros if little else F.lit(False)).alias("void"))
    # A file ends between two characters; after its last piece the reader has seen a byte 0A or the end.
    ends = (unit, unit + 1) if little else (0, 1, unit)
    records, splits = stitch(pieces, len(moves), ends, f"the file ends within a character of {name}")
    # Less the zeros of line feeds. A byte 0A that ends a file within its last character was taken for a separator.
    bare = F.when(F.col("line_no") == 0, F.col("record")).otherwise(F.expr(f"substring(record, {unit})")) if little else F.when(
        F.octet_length("record") % unit == 0, F.col("record")).when(
        F.substring("record", -(unit - 1), unit - 1) == zeros, F.expr(f"substring(record, 1, octet_length(record) - {unit - 1})")).otherwise(F.col("record"))
    text = F.when(F.octet_length(bare) % unit == 0, bare).otherwise(F.concat(bare, F.lit(bytearray(b"\n"))))
    # The decoder of the named byte order keeps a mark as U+FEFF; at a file's begin it is no text.
    allow_charset(spark, name)
    line = F.regexp_replace(F.decode(text, name), "\r\\z", "")
    line = F.when(F.col("line_no") == 0, F.regexp_replace(line, "\\A\ufeff", "")).otherwise(line)
    return records.select("file", "__block", "line_no", "row_no", line.alias("line")), splits


def _blank(unit: int, little: bool) -> str:
    """A pattern for the bytes of a line of blanks, with the zeros of a line feed."""
    zeros = "\\x00" * (unit - 1)
    return f"\\A(?:{zeros})?(?:[ \\r]{zeros})*\\z" if little else f"\\A(?:{zeros}[ \\r])*(?:{zeros})?\\z"


def _scan(spark: SparkSession, path, encoding: str, skip_blank: bool = False) -> DataFrame:
    cs = _charset(encoding)
    df = spark.read.text(path).withColumnRenamed("value", "line")
    if cs not in ("utf-8", "us-ascii"):
        # The text source passes a line's bytes on as they are.
        allow_charset(spark, cs)
        df = df.withColumn("line", F.decode(F.col("line").cast("binary"), cs))
    if skip_blank:
        # before the row ids are taken, so kept lines stay consecutive
        df = df.where(F.length(F.trim(F.col("line"))) > 0)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("__block"),
                     F.monotonically_increasing_id().alias("__mid"), "line")


def read_raw_lines(spark: SparkSession, path: str, encoding: str = "utf-8", across_files: bool = False,
                   skip_blank: bool = False) -> DataFrame:
    """Lines of the file(s) at ``path`` with 0-based per-file ``line_no``;
    ``across_files=True`` numbers the lines of all files as one sequence in
    file-name order (a directory written in parts by Spark reads back as the
    ordered whole). ``skip_blank=True`` drops empty (or whitespace-only)
    lines and numbers the rest. Line terminators (LF, CRLF, CR; in UTF-16 and
    UTF-32 LF and CRLF) are not part of ``line``."""
    if _charset(encoding) in WIDE_CHARSETS:
        lines, table = wide_lines(spark, path, _charset(encoding))
        if skip_blank:
            lines = lines.where("row_no IS NOT NULL").withColumn("line_no", F.col("row_no"))
            table = table.withColumn("total", F.col("rows"))
        if across_files:
            lines = lines.join(file_bases(table), "file").withColumn("line_no", F.col("line_no") + F.col("base"))
        return lines.select("file", "line_no", "line")
    # A partition's ids begin at a multiple of 2**33; the hash tells its splits apart.
    keys = {"__task": F.shiftright("__mid", 33), "__split": F.xxhash64("file", "__block")}
    scan = _scan(spark, path, encoding, skip_blank).withColumns(keys)
    splits = scan.groupBy("file", "__block", "__task", "__split").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    w = (Window.orderBy("file", "__block") if across_files else Window.partitionBy("file").orderBy("__block"))
    w = w.rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(w), F.lit(0)) - F.col("__first")
    splits = splits.select("__task", "__split", shift.alias("__shift"))
    out = scan.join(F.broadcast(splits), ["__task", "__split"])
    return out.select("file", (F.col("__shift") + F.col("__mid")).alias("line_no"), "line")


def _plain_name(name: str) -> str:
    """A file's name without what its lister adds: slashes after the scheme."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", r"\1/", name)


def _file_ranks(spark: SparkSession, names: list[str]) -> DataFrame:
    """file, rank in this order: one row for each file, which Spark's listing has on the driver."""
    return spark.createDataFrame([(_plain_name(n), i) for i, n in enumerate(names)], "__name string, rank bigint")


def read_ordered_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> tuple[DataFrame, str]:
    """The lines ``(ord, line)`` after the first, and the first line, of the
    file(s) at ``path`` as one sequence in file-name order. ``ord`` (file, split,
    place in the split) sorts as the lines stand; nothing is counted, so the text
    isn't scanned for it. Only the first line reaches the driver, from the first
    split of the first file."""
    names = sorted(spark.read.text(path).inputFiles(), key=unquote)  # Spark's names of files are URL-encoded
    if not names:
        raise ValueError(f"no file in {path}")
    charset, first = _charset(encoding), unquote(names[0])
    shown = F.regexp_replace("file", r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")
    in_first = shown == F.lit(_plain_name(names[0]))
    if charset in WIDE_CHARSETS:
        rows = wide_lines(spark, path, charset)[0].select("file", F.lit(0).cast("bigint").alias("__block"), F.col("line_no").alias("__mid"), "line")
        head = rows.where(in_first & (F.col("__mid") == 0)).select("__mid", "line").limit(1).collect()
        rest = rows.where(~in_first | (F.col("__mid") > 0))
    else:
        # The first file is scanned by itself: the id of its header line holds for that scan.
        own = _scan(spark, first, encoding)
        head = own.where(F.col("__block") == 0).select("__mid", "line").limit(1).collect()
        after = head[0]["__mid"] if head else -1
        rest = own.where((F.col("__block") != 0) | (F.col("__mid") > after))
        if len(names) > 1:
            rest = rest.unionByName(_scan(spark, path, encoding).where(~in_first))
    if not head:
        raise ValueError(f"no line in {first}")
    if len(names) == 1:
        place = rest.withColumn("rank", F.lit(0).cast("bigint"))
    else:
        place = rest.withColumn("__name", shown).join(F.broadcast(_file_ranks(spark, names)), "__name")
    return place.select(F.array("rank", "__block", "__mid").alias("ord"), "line"), head[0]["line"]
