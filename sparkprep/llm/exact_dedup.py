"""Operator 1, exact dedup, with DataFrame functions only.

Texts meet in three steps, each of which compares the whole text:

1. inside a map task the partial aggregate merges equal texts (local dedup): a
   task has one salt, so it sends one row for a text, however many copies it has;
2. ``(salt, digest, text)`` groups merge what the tasks have left. The tasks'
   salts spread the copies of one text over ``salts`` groups, so no reducer gets a
   hot text from all of them;
3. ``(digest, text)`` groups combine the winners of the salts: at most
   ``salts`` rows for a text.

The ids then fetch their group's winner by ``(digest, salt)``, where a group
of copies is spread over ``salts`` keys by the ids. A group of one knows its salt
from its only id, so only real groups of copies are written once per salt.

Defined results: a null text counts as empty; a null id never wins against
another id, and a group of null ids has a null ``keep_id``; of several rows
with the winning id and the same text one is kept; an empty table gives no
rows; further columns are ignored by ``exact_dedup`` and carried by
``drop_exact_copies``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import exact, spread, text_or_empty

SALTS = 16


def _hashed(docs: DataFrame, salts: int) -> DataFrame:
    return docs.withColumns({"text": text_or_empty(), "salt": spread("doc_id", salts)}).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))


def _local(docs: DataFrame, salts: int, *best) -> DataFrame:
    """Steps 1 and 2: equal texts of a task, then of the tasks of a salt."""
    return docs.withColumn("task", F.spark_partition_id() % salts).groupBy("task", "digest", "text").agg(*best)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = _hashed(exact(df, doc_id=id_col, text=text_col), salts)
    salted = _local(docs, salts, F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    groups = salted.groupBy("digest", "text").agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    winners = groups.select(
        "digest", "keep_id", "group_size",
        F.explode(F.when(F.col("group_size") == 1, F.array(spread("keep_id", salts))).otherwise(every_salt)).alias("salt"))
    of_row = docs.select("doc_id", "digest", "salt").join(winners, ["digest", "salt"])
    # Rows that repeat an id with the same text: one of them stays.
    turn = F.row_number().over(Window.partitionBy("digest", "salt", "doc_id").orderBy("group_size"))
    return of_row.withColumn("turn", turn).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns. The rest of a row rides
    with its id through the three steps, so whole rows need no join. Among
    rows with the same id and text the greatest in column order stays."""
    cols = df.columns
    i, t = cols.index(id_col), cols.index(text_col)
    flat = df.toDF(*[f"c{k}" for k in range(len(cols))])
    rest = [k for k in range(len(cols)) if k not in (i, t)]
    row = F.struct(F.col(f"c{i}").alias("doc_id"), F.col(f"c{t}").isNotNull().alias("has_text"),
                   *[F.col(f"c{k}") for k in rest])
    docs = _hashed(flat.select(F.col(f"c{i}").alias("doc_id"), F.col(f"c{t}").alias("text"), row.alias("row")), salts)
    salted = _local(docs, salts, F.max("row").alias("row"))
    best = salted.groupBy("digest", "text").agg(F.max("row").alias("row"))
    back = {i: F.col("row.doc_id"), t: F.when(F.col("row.has_text"), F.col("text"))}
    return best.select(*[back.get(k, F.col(f"row.c{k}")) for k in range(len(cols))]).toDF(*cols)
