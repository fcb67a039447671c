"""Operator 4, mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times. Walking
through the documents of a source, the expected copies are summed, one offset
in [0, 1) is added for the whole source, and a document is emitted once for
each whole number that the sum passes on its way over it. So the copies of a
document differ from the expectation by less than one, and those of any
stretch of documents too.

The walk goes by size band, part of a band, size and id. In that order the
documents of one size are met one after the other, so the words taken follow
the target closely and not only the number of documents.

The prefix sum is split: a source has up to ``PARTS`` parts for each size
band. Counts of the parts (a small table) give each part the sum it starts
with; inside a part a window counts on. A source with a third of all rows is
therefore many window groups.

Defined results: a null source is a source of its own and comes last in the
order of weights; null text counts as empty; documents without words are
emitted at their source's rate and take no words; a source without words has
target 0 and rate 0; the offset depends on the source's name and ``seed``
alone, so reruns agree; an empty table gives no rows. A null id counts as an
id that comes first; rows that repeat an id are documents of their own; a text of
any length is counted where it is read and not moved by the plan; further columns
are not looked at, but ``mix`` carries them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD_CLASS

PARTS = 64
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")


def _number_of(text: Column) -> Column:
    """32 bits of a digest, which any SQL engine can compute too."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def offset_of(source: Column, seed: int) -> Column:
    """A fixed number in [0, 1) for a source, in steps of 2**-32."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return _number_of(name).cast("double") / F.lit(float(2**32))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Round by round, the words that capped sources can't take go to the others
    by weight, until none is above its cap. A round is one aggregate over the
    table of sources; each round caps one more source at least, in practice
    there are two or three. The places in code-point order are counted range by
    range, so that a very long list of sources is not one window."""
    # Sources in ranges, sorted inside; a row's id has its range and its place there.
    ordered = sizes.withColumn("none", F.col("source").isNull()).repartitionByRange("none", "source")
    ordered = ordered.sortWithinPartitions("none", "source").withColumn("mid", F.monotonically_increasing_id())
    ordered = materialize(ordered).withColumns({"range": F.shiftright("mid", 33), "inner": F.col("mid").bitwiseAND((1 << 33) - 1)})
    ranges = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.col("before") + F.col("inner")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    placed = materialize(ordered.join(ranges.select("range", before.alias("before")), "range")
                         .select("source", "source_size", weight.cast("long").alias("weight")))

    total = placed.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    share = (0, 1)  # words for each unit of weight, as a fraction of whole numbers
    left, unit = total, placed.agg(F.sum("weight").alias("w")).first()["w"] or 1
    while True:
        share = (left, unit)
        above = F.col("weight") * F.lit(left) / F.lit(unit) > F.col("source_size") * cap
        r = placed.agg(F.sum(F.when(above, F.col("source_size"))).alias("full"),
                       F.sum(F.when(~above, F.col("weight"))).alias("unit")).first()
        now = (total - cap * (r["full"] or 0), r["unit"] or 0)
        if now == share or not now[1]:
            break
        left, unit = now
    by_weight = F.col("weight") * F.lit(share[0]) / F.lit(share[1])
    top = (F.col("source_size") * cap).cast("double")
    return placed.select("source", "source_size", F.when(by_weight > top, top).otherwise(by_weight).alias("target"))


def _walk(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The rows with what the walk goes by: doc_id, skey (the source's name, null apart), size, tie."""
    cols = df.columns
    flat = df.toDF(*[f"c{k}" for k in range(len(cols))])
    i, t, s = (F.col(f"c{cols.index(c)}") for c in (id_col, text_col, source_col))
    return flat.withColumns({"doc_id": i, "source": s, "size": word_count(t), "tie": F.xxhash64(t),
                             "skey": F.coalesce(F.concat(F.lit("s"), s), F.lit("n"))})


def copies(rows: DataFrame, slim: DataFrame, weights=WEIGHTS, cap: float = CAP, seed: int = SEED, parts: int = PARTS) -> DataFrame:
    """Adds source_size, target and n_copies to ``rows`` (of ``_walk``).
    ``slim`` has doc_id, source, skey and size of the same rows."""
    # The size band is the bit length of the size, so the walk needs no sampled bounds.
    place = {"band": F.length(F.bin("size")), "part": _number_of(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts}
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    targets = targets.withColumn("skey", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    counts = slim.withColumns(place).groupBy("skey", "band", "part").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("skey").orderBy("band", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("skey", "band", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("start"))
    starts = starts.join(targets.select("skey", "source_size", "target"), "skey")
    # One part of one source is one window group.
    turn = F.row_number().over(Window.partitionBy("skey", "band", "part").orderBy("size", "doc_id", "tie")).cast("long")
    numbered = rows.withColumns(place).withColumn("turn", turn).join(starts, ["skey", "band", "part"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # The sum over k documents is k * rate: its whole part adds copies to every
    # document, its fraction is what passes whole numbers now and then.
    fraction, u, k = F.col("rate") - F.floor("rate"), offset_of(F.col("source"), seed), F.col("start") + F.col("turn")
    passed = F.floor(k * fraction + u) - F.floor((k - 1) * fraction + u)
    return numbered.withColumn("rate", rate).withColumn("n_copies", (F.floor("rate") + passed).cast("long"))


def mix_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """doc_id, size, source_size, target, taken, n_copies for every document."""
    slim = materialize(_walk(df, id_col, text_col, source_col).select("doc_id", "source", "skey", "size", "tie"))
    return copies(slim, slim, **how).select(
        "doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"), "n_copies")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed corpus: every row as often as the plan emits it, columns as they were.

    The plan is made of rows without texts; the texts are not sorted but go by the
    plan's rows of their partition, which a task holds."""
    # Written, so the numbers stay.
    rows = materialize(_walk(df, id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id()))
    slim = rows.select("row", "doc_id", "source", "skey", "size", "tie")
    plan = copies(slim, slim, **how).where("n_copies > 0").select("row", "n_copies")
    cols = [f"c{k}" for k in range(len(df.columns))]
    out = rows.select("row", *cols).join(plan.hint("shuffle_hash"), "row")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    return out.select(*cols).toDF(*df.columns)
