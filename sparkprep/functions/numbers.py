"""Number standardisers as native column expressions (C3 row steps, C4).

The float rule (C3) has a column-wide part: whether any value of the column
has several dots, exactly one dot, several commas, one comma or a percent
sign. ``float_flags`` builds those flags as aggregate expressions (one pass
for every float column at once); the row steps take the flags as columns, which
the caller gives as literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text a Python float() accepts that we accept too.
FLOAT_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DIGITS = r"^[0-9]+$"


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def clean_int(c: Column | str, on_error: str = "fail") -> Column:
    """C4: null -> ''; ',' -> '.'; drop spaces; with several dots keep only
    the last one; keep the text before the dot; anything but digits -> 0.

    Dropping all dots but the last and then cutting at the dot equals
    cutting at the last dot and dropping the remaining dots."""
    v = F.coalesce(_text(c), F.lit(""))
    v = F.replace(F.replace(v, F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
    v = F.replace(F.regexp_replace(v, r"[.][^.]*$", ""), F.lit("."), F.lit(""))
    as_long = v.try_cast("bigint")
    if on_error == "fail":
        as_long = F.coalesce(as_long, F.raise_error(F.concat(F.lit("int out of range: "), v)).cast("bigint"))
    else:
        as_long = F.coalesce(as_long, F.lit(0).cast("bigint"))
    return F.when(v.rlike(DIGITS), as_long).otherwise(F.lit(0).cast("bigint"))


def _count(v: Column, ch: str) -> Column:
    return F.length(v) - F.length(F.replace(v, F.lit(ch), F.lit("")))


def float_prepared(c: Column | str) -> Column:
    """Step 1: null, '.' and empty text become '-1'."""
    v = _text(c)
    return F.when(v.isNull() | (v == ".") | (v == ""), F.lit("-1")).otherwise(v)


def float_flags(c: Column | str, prefix: str) -> list[Column]:
    """Aggregate expressions for the column-wide part of C3, named
    ``<prefix>__md`` (max dots), ``__d1`` (any single dot), ``__mc`` (max
    commas), ``__c1`` (any single comma), ``__pc`` (any percent sign)."""
    v = float_prepared(c)
    dots, commas = _count(v, "."), _count(v, ",")
    return [
        F.max(dots).alias(f"{prefix}__md"),
        F.max((dots == 1).cast("int")).alias(f"{prefix}__d1"),
        F.max(commas).alias(f"{prefix}__mc"),
        F.max((commas == 1).cast("int")).alias(f"{prefix}__c1"),
        F.max(F.contains(v, F.lit("%")).cast("int")).alias(f"{prefix}__pc"),
    ]


def float_step2(v: Column, md: Column, d1: Column, mc: Column, c1: Column,
                decimal: str | None = None) -> Column:
    """Step 2: column-wide, first matching rule only."""
    dec = F.lit(decimal)
    after_dot = F.try_element_at(F.split(v, r"[.]"), F.lit(2))
    after_comma = F.try_element_at(F.split(v, ","), F.lit(2))
    return (F.when(md > 1, F.replace(v, F.lit("."), F.lit("")))
             .when((d1 == 1) & dec.eqNullSafe(","),
                   F.when((F.locate(".", v) > 1) & (F.length(after_dot) > 2),
                          F.replace(v, F.lit("."), F.lit(""))).otherwise(v))
             .when(mc > 1, F.replace(v, F.lit(","), F.lit("")))
             .when((c1 == 1) & dec.eqNullSafe("."),
                   F.when((F.locate(",", v) > 1) & (F.length(after_comma) > 2),
                          F.replace(v, F.lit(","), F.lit(""))).otherwise(v))
             .otherwise(v))


def float_step3(v: Column, pc: Column) -> Column:
    """Step 3: a percent sign anywhere in the column -> drop every '%'."""
    return F.when(pc == 1, F.replace(v, F.lit("%"), F.lit(""))).otherwise(v)


# The row rules of step 4 as patterns over the text.
_ONE_COMMA_NO_DOT = r"^[^,.]*,[^,.]*$"
_ONE_DOT_NO_COMMA = r"^[^.,]*[.][^.,]*$"
_TWO_DOTS = r"[.].*[.]"
_DOT_PAST_START = r"^[^.]+[.]"
_TWO_AFTER_LAST_COMMA = r",[^,]{2}$"
_COLON_PAST_START = r"^[^:]+:"


def float_step4(v: Column) -> Column:
    """Step 4: row rules (first match; a converted value is final). Written
    as regex tests: the same logic as counting separators, in far less
    generated code, so wide tables stay within the JIT's method size."""
    return (F.when(v.rlike(_ONE_COMMA_NO_DOT), F.replace(v, F.lit(","), F.lit(".")))
             .when(v.rlike(_ONE_DOT_NO_COMMA), v)
             .when(v.rlike(_TWO_DOTS), F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
             .when(v.rlike(_TWO_AFTER_LAST_COMMA) & v.rlike(_DOT_PAST_START),
                   F.concat(F.regexp_replace(F.regexp_replace(v, ",[^,]*$", ""), "[.,]", ""),
                            F.lit("."), F.substring_index(v, ",", -1)))
             .when(v.rlike(_COLON_PAST_START), F.lit("-1"))
             .otherwise(v))


def float_fails(v: Column) -> Column:
    """True when step 5 cannot cast the (step 4) text."""
    return ~F.trim(v).rlike(FLOAT_TEXT)


def int_overflows(c: Column | str) -> Column:
    """True when a C4 value is all digits but does not fit a BIGINT."""
    v = F.coalesce(_text(c), F.lit(""))
    v = F.replace(F.replace(v, F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
    v = F.replace(F.regexp_replace(v, r"[.][^.]*$", ""), F.lit("."), F.lit(""))
    return v.rlike(DIGITS) & v.try_cast("bigint").isNull()


def float_cast(v: Column, on_error: str = "fail") -> Column:
    """Step 5: cast to double (failure aborts, or -1 with 'sentinel'), then -1 -> 0."""
    t = F.trim(v)
    parsed = F.when(t.rlike(FLOAT_TEXT), t.cast("double"))
    if on_error == "fail":
        parsed = F.coalesce(parsed, F.raise_error(F.concat(F.lit("not a float: "), v)).cast("double"))
    else:
        parsed = F.coalesce(parsed, F.lit(-1.0))
    return F.when(parsed == -1.0, F.lit(0.0)).otherwise(parsed)


def clean_float(c: Column | str, md: Column, d1: Column, mc: Column, c1: Column, pc: Column,
                decimal: str | None = None, on_error: str = "fail") -> Column:
    """C3 row steps given the column-wide flags, as one expression (for
    streams and ad-hoc use; the DataFrame operator stages the steps as
    separate projections so the optimizer does not inline them)."""
    v = float_prepared(c)
    v = float_step2(v, md, d1, mc, c1, decimal)
    v = float_step3(v, pc)
    return float_cast(float_step4(v), on_error)
