"""Places of rows in their group's order, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def group_key(col: Column) -> Column:
    """A text that is never null and sorts as the group: null first."""
    return F.when(col.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), col.cast("string")))


def numbered(df: DataFrame, order: list[Column], group: str = "g", pos: str = "pos") -> DataFrame:
    """Adds ``pos``, a row's 0-based place in its group by ``order``; written
    once to the shared folder. ``group`` is a text column without nulls.

    The rows are sorted by range, so a group of any size lies in as many tasks
    as its rows need; rows equal in all of ``order`` are split by their own
    place. A task counts within itself. Only its first group can have begun
    in an earlier task; what that adds is carried over on the driver, which
    reads one row a task."""
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("__tie")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")

    def task(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, count, first = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = batch.column(group)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)
            new[0] = names[0].as_py() != last
            begins = np.flatnonzero(new)
            run = np.cumsum(new)
            at = np.arange(n) - np.concatenate([[0], begins])[run]
            at[:begins[0] if len(begins) else n] += count
            head = np.zeros(n, bool)
            if first:
                # Rows before the second group that the task sees.
                second = begins[begins > 0] if last is None else begins
                head[:second[0] if len(second) else n] = True
                first = not len(second)
            last, count = names[n - 1].as_py(), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(head),
                                              pa.array(np.full(n, part), pa.int32())], [*batch.schema.names, "__at", "__head", "__part"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = materialize(rows.mapInArrow(task, f"{schema}, __at bigint, __head boolean, __part int"))
    ends = placed.groupBy("__part").agg(
        F.min(group).alias("first"), F.max(F.struct(group, "__at")).alias("last")).orderBy("__part").collect()
    before, carry, carried = [], 0, None
    for e in ends:
        more = carry if e["first"] == carried else 0
        if more:
            before.append((e["__part"], more))
        alone = e["first"] == e["last"][0]
        carried, carry = e["last"][0], e["last"]["__at"] + 1 + (more if alone else 0)
    out = placed
    if before:
        # One row a task at most.
        shift = df.sparkSession.createDataFrame(before, "__part int, __before bigint")
        out = placed.join(F.broadcast(shift), "__part", "left")
        place = F.col("__at") + F.when(F.col("__head"), F.coalesce("__before", F.lit(0))).otherwise(F.lit(0))
        return out.withColumn(pos, place).drop("__at", "__head", "__part", "__before")
    return out.withColumnRenamed("__at", pos).drop("__head", "__part")
