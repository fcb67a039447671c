"""Pseudonymisation.

``mask_columns`` replaces values by stable pseudonyms and keeps a persistent
dictionary of ``(value, key)`` rows for each dictionary name under
``references_path``. A key is 32 hex digits of a hash of the value, keyed with a
random secret that the folder gets once, by an exclusive create. So a value's
key never depends on which run met it first: runs side by side agree, a run that
is repeated agrees, and masking itself is a projection without a join. Columns
naming the same dictionary share its keys; other dictionaries give the same
value other keys. A null is masked as its text form ``'nan'``.

The secret is no part of a query's plan: expressions take it from a one-row table
at run time, so neither ``explain`` nor an event log shows it.

The dictionary is kept for reading back. One pass over the table gives the
distinct ``(dictionary, value)`` pairs of all masked columns, combined in each
task, and those not yet known are appended. Two runs may both append a value;
the rows are equal.

``mask_keyed`` is the dictionary-free variant: ``sha2(salt || value)``; the salt
is kept out of the plan too."""

from __future__ import annotations

import secrets
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_folder

NULL_TEXT = "nan"
SECRET = "_secret"
SECRET_CHARS = 64


def _as_text(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_TEXT))


def dictionary_path(references_path: str, name: str) -> str:
    return f"{references_path.rstrip('/')}/dictionary={name}"


def secret_of(spark: SparkSession, references_path: str, wait_seconds: int = 60) -> str:
    """The folder's secret. Creating the file fails if it is there already,
    so of several first runs one decides and the others read its secret,
    waiting for its end if it is just being written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{references_path.rstrip('/')}/{SECRET}")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        try:
            out = fs.create(place, False)
        except Py4JJavaError:
            if not fs.exists(place):
                raise
        else:
            out.writeBytes(secrets.token_hex(SECRET_CHARS // 2))
            out.close()
    for _ in range(wait_seconds * 10):
        stream = fs.open(place)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if len(text) == SECRET_CHARS:
            return text
        time.sleep(0.1)
    raise ValueError(f"{place.toString()} is incomplete: the run that made it did not end")


def hidden(spark: SparkSession, text: str) -> Column:
    """A text as an expression that the plan doesn't show: the value of a
    one-row table, which is read when the query runs."""
    return spark.createDataFrame([(text,)], "hidden string").scalar()


def key_of(value: Column, name: str, secret: Column) -> Column:
    """The key of a text value in dictionary ``name``; ``secret`` as ``hidden``."""
    return F.substring(F.sha2(F.concat(secret, F.lit(f":{len(name)}:{name}:"), value), 256), 1, 32)


def read_dictionary(spark: SparkSession, references_path: str, name: str) -> DataFrame:
    """The dictionary ``(value, key)``: one key per value."""
    if not list_folder(spark, dictionary_path(references_path, name)):
        return spark.createDataFrame([], "value string, key string")
    return spark.read.parquet(dictionary_path(references_path, name)).select("value", "key").distinct()


def column_values(df: DataFrame, mask_cols: dict[str, str]) -> DataFrame:
    """Distinct (dictionary, value) of all masked columns in one pass,
    combined map-side: a value holding a large share of the rows costs one
    row per task."""
    each = F.array(*[F.struct(F.lit(d).alias("dictionary"), _as_text(c).alias("value")) for c, d in mask_cols.items()])
    return df.select(F.explode(F.array_distinct(each)).alias("m")).select("m.*").distinct()


def extend_dictionaries(df: DataFrame, references_path: str, mask_cols: dict[str, str], secret: str) -> None:
    """Append the values not yet known to their dictionaries, in one write
    (a retried task writes its own files again)."""
    spark = df.sparkSession
    new = column_values(df, mask_cols)
    names = sorted(set(mask_cols.values()))
    known = [read_dictionary(spark, references_path, d).select(F.lit(d).alias("dictionary"), "value") for d in names
             if list_folder(spark, dictionary_path(references_path, d))]
    for k in known:
        new = new.join(k, ["dictionary", "value"], "left_anti")
    key, shared = F.lit(None).cast("string"), hidden(spark, secret)
    for d in names:
        key = F.when(F.col("dictionary") == d, key_of(F.col("value"), d, shared)).otherwise(key)
    new.withColumn("key", key).write.mode("append").partitionBy("dictionary").parquet(references_path)


def mask_columns(df: DataFrame, references_path: str, mask_cols: dict[str, str]) -> DataFrame:
    """Replace each column in ``mask_cols`` (column -> dictionary name) by its
    key and extend the dictionaries by the table's new values."""
    for c in mask_cols:
        if c not in df.columns:
            raise KeyError(f"column {c!r} not in the table")
    secret = secret_of(df.sparkSession, references_path)
    extend_dictionaries(df, references_path, mask_cols, secret)
    shared = hidden(df.sparkSession, secret)
    return df.withColumns({c: key_of(_as_text(c), d, shared) for c, d in mask_cols.items()})


def mask_keyed(df: DataFrame, cols: list[str], salt: str) -> DataFrame:
    """Deterministic pseudonyms without a dictionary: ``sha2(salt || text, 256)``.
    No shuffle; only as secret as the salt."""
    shared = hidden(df.sparkSession, salt)
    return df.withColumns({c: F.sha2(F.concat(shared, _as_text(c)), 256) for c in cols})
