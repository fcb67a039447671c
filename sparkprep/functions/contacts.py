"""Contact extraction as native higher-order-function folds.

Both walk a text once with ``aggregate`` over an array built by a regex or a
split, so they run inside the JVM on whole texts of any length; no Python
worker is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# E-mail endings recognised as the end of a domain, in the
# order they are tried.
EMAIL_ENDINGS = [".com", ".pt", ".eu", ".biz", ".es", ".org", ".net", ".de"]
# Digits glue together until a run reaches this many.
PHONE_MIN_DIGITS = 9

_WORD_LEAD = r"^[^\p{L}\p{N}_]+"
_NON_ASCII = r"[^\x00-\x7F]"


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def phone_numbers(c: Column | str) -> Column:
    """Digit runs are glued until they reach 9 digits, then emitted; a
    shorter tail replaces the last digits of the previous number (or is
    dropped when there is none); numbers longer than 9 digits get a '+'.
    Returns ``array<string>``."""
    runs = F.regexp_extract_all(_text(c), F.lit("[0-9]+"), F.lit(0))
    empty = F.array().cast("array<string>")
    init = F.struct(F.lit("").alias("acc"), empty.alias("out"))

    def step(st, r):
        glued = F.concat(st["acc"], r)
        return F.when(F.length(glued) >= PHONE_MIN_DIGITS,
                      F.struct(F.lit("").alias("acc"), F.array_append(st["out"], glued).alias("out"))
                      ).otherwise(F.struct(glued.alias("acc"), st["out"].alias("out")))

    def finish(st):
        acc, out = st["acc"], st["out"]
        last = F.element_at(out, -1)
        tail = F.concat(F.left(last, F.length(last) - F.length(acc)), acc)
        nums = (F.when(acc == "", out)
                 .when(F.size(out) > 0, F.array_append(out, tail))
                 .otherwise(out))
        return F.transform(nums, lambda n: F.when(F.length(n) > PHONE_MIN_DIGITS, F.concat(F.lit("+"), n))
                           .otherwise(n))

    return F.aggregate(runs, init, step, finish)


def _email_local(prev: Column) -> Column:
    """Local part: lower, no spaces, leading non-word chars dropped, ASCII only."""
    v = F.regexp_replace(F.lower(F.replace(prev, F.lit(" "), F.lit(""))), _WORD_LEAD, "")
    return F.regexp_replace(v, _NON_ASCII, "")


def emails(c: Column | str) -> Column:
    """Split on '@'; each right part, lower-cased without spaces/tabs, ends
    at the known ending whose first occurrence (past position 0) is right-most;
    the left part gives the local name; text after the ending seeds the next
    address. Returns ``array<string>``."""
    parts = F.split(_text(c), "@", -1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    empty = F.array().cast("array<string>")
    init = F.struct(F.element_at(parts, 1).alias("prev"), F.lit(False).alias("skip"), empty.alias("out"))

    def step(st, part):
        bite = F.replace(F.replace(F.lower(part), F.lit(" "), F.lit("")), F.lit("\t"), F.lit(""))
        # bind bite and the best ending once: (pos, end) of the right-most
        # first occurrence, pos 0 when none
        cands = F.array(*[F.struct(F.locate(e, bite).alias("p"), F.lit(len(e)).alias("n"))
                          for e in EMAIL_ENDINGS])
        best = F.array_max(F.filter(cands, lambda s: s["p"] > 1))
        bound = F.struct(bite.alias("bite"), best.alias("best"))

        def on(z):
            b, best_ = z["bite"], z["best"]
            end = best_["p"] - 1 + best_["n"]
            local = _email_local(st["prev"])
            out = F.when(F.length(local) > 0,
                         F.array_append(st["out"], F.concat(local, F.lit("@"), F.left(b, end)))
                         ).otherwise(st["out"])
            matched = F.struct(F.substring(b, end + 1, 1 << 30).alias("prev"),
                               (end >= F.length(b)).alias("skip"), out.alias("out"))
            missed = F.struct(part.alias("prev"), F.lit(True).alias("skip"), st["out"].alias("out"))
            return F.when(best_.isNull(), missed).otherwise(matched)

        active = F.element_at(F.transform(F.array(bound), on), 1)
        skipped = F.struct(part.alias("prev"), F.lit(False).alias("skip"), st["out"].alias("out"))
        return F.when(st["skip"], skipped).otherwise(active)

    return F.aggregate(rest, init, step, lambda st: st["out"])
