"""Standardisation on Structured Streaming.

The reference is batch-only. Its row-wise operators (strings, tax ids, ints,
dates, phone and e-mail extraction) need no state and run unchanged on a
streaming DataFrame. Two operators are column-wide or stateful:

* the float rule decides per column from *all* values (any value with two
  dots, ...). On an unbounded stream "all" never ends, so the flags come from
  the spec (``float_flags``), or ``foreachBatch`` merges each micro-batch's flags
  with those of all batches before (``merge_flags``). A batch that changes them
  has the earlier batches, kept as they came, written again under the new ones.
  So the output is always that of one table with all rows so far, and as flags
  only grow, that happens a few times in a stream's life;
* masking extends a persistent dictionary, done per micro-batch in
  ``foreachBatch`` (a batch replayed after a failure finds its values
  already in the dictionary and reuses their keys).

``standardize_batches`` writes each micro-batch as its own partition
``batch_id=<n>`` with dynamic overwrite, so a replayed batch replaces its
own output: the sink is idempotent, and with the checkpoint folder that a
restart names again each row is in the output once."""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import names as NM
from ..operators import standardize as S
from ..operators.names import split_list
from ..plans import process as P
from ..session import list_folder, read_file, replace_file


def standardize_stream(stream: DataFrame, data_types: dict, float_flags: dict[str, dict] | None = None,
                       on_error: str = "sentinel") -> DataFrame:
    """Row-wise part of F1 on a streaming DataFrame (dates, floats with
    declared flags, tax ids, strings, ints). ``on_error`` defaults to
    'sentinel': one bad row should not stop a long-running stream."""
    spec = dict(data_types)
    df = stream
    for tag in S.CLASS_ORDER:
        if tag == "float_cols":
            if not spec.get(tag):
                continue
            cols = S.present_columns(split_list(spec[tag]), df.columns, spec.get("optional", 1))
            if not cols:
                continue
            if float_flags is None:
                raise ValueError("float columns on a stream need declared flags (or use standardize_batches)")
            df = S.floats(df, cols, 1, spec.get("decimal"), on_error, flags=float_flags)
        else:
            df = S.transform(df, tag, spec, on_error=on_error)
    return df


def standardize_batches(data_types: dict, output_path: str, mask_data: dict | None = None,
                        on_error: str = "fail") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function running the whole F1 and writing the batch
    idempotently. With float columns the batches are also kept as they came, in
    ``<output>/_batches``, and the flags merged so far in ``<output>/_flags.json``."""
    base = output_path.rstrip("/")

    def write(rows: DataFrame, batch_id: int, flags: dict | None) -> None:
        out = P.standardize_table(rows, data_types, mask_data, on_error, flags=flags)
        (out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(base))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = [c for c in split_list(NM.expand_wildcards(data_types, batch.columns).get("float_cols") or "") if c in batch.columns]
        if not cols:
            write(batch, batch_id, None)
            return
        kept = f"{base}/_batches/batch={batch_id}"
        batch.write.mode("overwrite").parquet(kept)
        batch = spark.read.schema(batch.schema).parquet(kept)
        before = json.loads(read_file(spark, f"{base}/_flags.json") or "{}")
        flags = S.merge_flags(before, S.float_flags(batch, cols))
        changed = [n for n in list_folder(spark, f"{base}/_batches") if before and flags != before]
        for name in changed or [f"batch={batch_id}"]:
            rows = spark.read.schema(batch.schema).parquet(f"{base}/_batches/{name}")
            write(rows, int(name.split("=")[1]), flags)
        # Last, so that a batch that fails on the way finds the old flags again and writes all once more.
        replace_file(spark, f"{base}/_flags.json", json.dumps(flags))

    return run


def start_standardize(stream: DataFrame, data_types: dict, output_path: str, mask_data: dict | None = None,
                      *, checkpoint: str, trigger: dict | None = None):
    """Start the ``foreachBatch`` query. ``checkpoint`` is a folder on shared
    storage that a restart names again: it holds what has been read."""
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder to restart without repeats")
    w = stream.writeStream.foreachBatch(standardize_batches(data_types, output_path, mask_data))
    w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
