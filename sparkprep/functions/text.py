"""Text standardisers as ``Column -> Column`` functions (C1, C5) and the
column-name rule (B1, a driver-side rule over ``df.columns``).

All are native Spark expressions: they stay inside whole-stage codegen and
never start a Python worker."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Unicode "non-word" character (anything that is not a
# letter, a number or an underscore). Java's plain \W is ASCII-only.
NON_WORD = r"[^\p{L}\p{N}_]"
# Whitespace stripped at both ends of a tax id (Python's
# notion of whitespace, written out because Java's \s is ASCII-only).
EDGE_SPACE = r"^[\t\n\x0b\f\r\x1c-\x1f \x85\p{Z}]+|[\t\n\x0b\f\r\x1c-\x1f \x85\p{Z}]+$"


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def clean_string(c: Column | str, whole_value_only: bool = False) -> Column:
    """Null -> '', drop spaces, lower, drop 'nan' then 'none' anywhere in
    the text, drop every non-word character.

    ``whole_value_only=True`` blanks 'nan'/'none' only when they are the
    whole value instead of removing them inside words."""
    v = F.lower(F.replace(F.coalesce(_text(c), F.lit("")), F.lit(" "), F.lit("")))
    if whole_value_only:
        v = F.when(v.isin("nan", "none"), F.lit("")).otherwise(v)
    else:
        v = F.replace(F.replace(v, F.lit("nan"), F.lit("")), F.lit("none"), F.lit(""))
    return F.regexp_replace(v, NON_WORD, "")


def clean_tax_id(c: Column | str) -> Column:
    """Null -> '0'; trim; lower; keep text before the first '.' and then
    before the first ','; each non-word char -> '0'; 'nan' -> '0'. Text out."""
    v = F.coalesce(_text(c), F.lit("0"))
    v = F.lower(F.regexp_replace(v, EDGE_SPACE, ""))
    v = F.substring_index(F.substring_index(v, ".", 1), ",", 1)
    v = F.regexp_replace(v, NON_WORD, "0")
    return F.replace(v, F.lit("nan"), F.lit("0"))


def standardize_name(name: str) -> str:
    """B1 for one column name: 'Ç' -> 'C', lower, every char outside
    [a-zA-Z0-9 newline .] -> space, space -> '_'."""
    name = name.replace("Ç", "C").lower()
    name = re.sub(r"[^a-zA-Z0-9 \n.]", " ", name)
    return name.replace(" ", "_")
