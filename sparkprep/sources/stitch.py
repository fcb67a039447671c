"""Records that a line reader has cut in the wrong places, put together again
in parallel.

Spark cuts a file into splits and each split into pieces at the byte of a line
feed. Whether that byte ends a record may depend on all that comes before it: a
line feed in a quoted cell doesn't (the state is "inside quotes"), nor does such a
byte within a character of UTF-16 or UTF-32 (the state is the offset within a
character). Both are automata: a piece takes each of ``k`` states to another, and
tells under which states it begins a record.

Pieces compose, so no task has to know where a file's other splits stand:

1. each split is summarised under every state it might begin in (``k`` rows);
2. a file's summaries are composed in order, one row per split and state, which
   gives the state every split begins in;
3. each split is read again from its known state, and records that lie within a
   split are put together as they stream by. Only if some record goes on into
   another split, the pieces of such records (told by their places, which the
   split table has) are taken from one more scan and shuffled.

The split table (one row a split, some 100 bytes) is broadcast to step 3; a record
must fit into a task's memory, as everywhere in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Added to the state after a piece, if the piece begins a record.
BEGINS = 64


def move(after: Column, begins: Column) -> Column:
    """What a piece does in one state: the state after it, and whether it begins a record."""
    return (after + F.when(begins, F.lit(BEGINS)).otherwise(F.lit(0))).cast("tinyint")


def _key(df: DataFrame) -> DataFrame:
    """The split's name as a number."""
    return df.withColumn("__split", F.xxhash64("file", "__block"))


def _follow(moves, start: int, k: int):
    """For each piece whether it begins a record, and the state after the last."""
    import numpy as np

    n = len(moves)
    state, at = start, 0
    before = np.empty(n, np.int64)
    for i in np.flatnonzero(((moves & (BEGINS - 1)) != np.arange(k)).any(axis=1)).tolist():
        before[at:i + 1] = state
        at, state = i + 1, int(moves[i, state]) & (BEGINS - 1)
    before[at:] = state
    return moves[np.arange(n), before] >= BEGINS, state


def _runs(batch, k: int):
    """The pieces of a batch cut by split: (file, block, first, size, moves)."""
    import numpy as np

    splits = batch.column("__split").to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)] if len(splits) else [0]
    for first, end in zip(cuts, cuts[1:]):
        moves = np.asarray(batch.column("moves").slice(first, end - first).flatten(), np.int64).reshape(-1, k)
        yield batch.column("file")[first].as_py(), batch.column("__block")[first].as_py(), first, end - first, moves


_SUMMARY = ("file string, __block bigint, s int, e int, n bigint, filled bigint, blank boolean, void boolean, entered boolean, "
            "head_end bigint, tail bigint")


def _summaries(pieces: DataFrame, k: int) -> DataFrame:
    """Per split and state it might begin in (s): the state it ends in (e), the
    records that begin in it (n; filled: those that aren't blank), whether the
    last piece begins a blank or a void one, whether the first piece goes on
    with a record (entered), the last piece of that record (head_end), and the
    piece that begins the split's last record (tail)."""

    def task(batches):
        import numpy as np
        import pyarrow as pa

        names = [c.split()[0] for c in _SUMMARY.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]

        def closed(split, rows):
            cols = zip(*((s, *r) for s, r in enumerate(rows)))
            return pa.RecordBatch.from_arrays([pa.array([split[0]] * k), pa.array([split[1]] * k, pa.int64()),
                                               *(pa.array(c, t) for c, t in zip(cols, kinds))], names)

        split, rows = None, []
        for batch in batches:
            for file, block, first, size, moves in _runs(batch, k):
                fresh = (file, block) != split
                if fresh:
                    if split is not None:
                        yield closed(split, rows)
                    split, rows = (file, block), [(s, 0, 0, False, False, None, None, None) for s in range(k)]
                mids = batch.column("__mid").slice(first, size).to_numpy()
                blank, void = (batch.column(c).slice(first, size).to_numpy(zero_copy_only=False) for c in ("blank", "void"))
                new = []
                for state, n, filled, was_blank, _, entered, head_end, tail in rows:
                    begins, state = _follow(moves, state, k)
                    places = np.flatnonzero(begins)
                    if fresh:
                        entered = not begins[0]
                    if was_blank and not begins[0]:
                        filled += 1  # what looked blank goes on
                    if entered and n == 0:
                        head_end = int(mids[places[0] - 1] if len(places) and places[0] else mids[-1]) if not begins[0] else head_end
                    # A blank piece is a blank record if the next begins another; the last one is told later.
                    alone = begins & blank & np.append(begins[1:], True)
                    n, filled = n + len(places), filled + len(places) - int(alone.sum())
                    tail = int(mids[places[-1]]) if len(places) else tail
                    new.append((state, n, filled, bool(alone[-1]), bool(begins[-1] and void[-1]), entered, head_end, tail))
                rows = new
        if split is not None:
            yield closed(split, rows)

    return pieces.select("file", "__block", "__split", "__mid", "moves", "blank", "void").mapInArrow(task, _SUMMARY)


_SPLITS = ("file string, __block bigint, start int, n bigint, filled bigint, first_no bigint, first_row bigint, opened bigint, "
           "opened_no bigint, opened_row bigint, head_end bigint, tail bigint, total bigint, rows bigint")


def _starts(summaries: DataFrame, k: int, ends: tuple[int, ...], unfinished: str) -> DataFrame:
    """Per split: the state it begins in, the records that begin in it and
    before it in its file, the record open at its begin (its split and
    numbers), and the pieces where records that cross its ends end and begin."""

    def file(table):
        import pyarrow as pa

        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["__block"], r["s"]))
        state, no, row, out = 0, 0, 0, []
        for i in range(0, len(rows), k):
            r = rows[i + state]
            if r["entered"]:
                # The last split in which a record began has the one that goes on here.
                last = next(o for o in reversed(out) if o["n"])
                if last["tail"] is None:
                    last["tail"], last["filled"] = last["last"], last["filled"] + last["blank"]
                    row += last["blank"]
                opened = last["__block"], last["first_no"] + last["n"] - 1, last["first_row"] + last["filled"] - 1
            out.append({"file": r["file"], "__block": r["__block"], "start": state, "n": r["n"], "filled": r["filled"], "first_no": no,
                        "first_row": row, "tail": None, "last": r["tail"], "blank": int(r["blank"]),
                        **dict(zip(("opened", "opened_no", "opened_row"), opened if r["entered"] else (None,) * 3)),
                        "head_end": r["head_end"] if r["entered"] else None})
            no, row, state = no + r["n"], row + r["filled"], r["e"]
        if state not in ends:
            raise ValueError(f"{unfinished}: {rows[0]['file']}")
        no -= r["void"]
        fields = [c.split() for c in _SPLITS.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
        return pa.table({c: pa.array([{**o, "total": no, "rows": row}[c] for o in out], kinds[t]) for c, t in fields})

    return summaries.groupBy("file").applyInArrow(file, _SPLITS)


def stitch(pieces: DataFrame, k: int, ends: tuple[int, ...], unfinished: str) -> tuple[DataFrame, DataFrame]:
    """Records from pieces (file, __block, __mid, piece, moves, blank, void), in
    the order the scan gives them. ``piece`` is binary; ``moves`` has a ``move``
    for each state before the piece (a file begins in state 0, and must end in
    one of ``ends``); a record of one blank piece is blank; a file's last record
    is none if it is one void piece.

    Gives the records (file, __block, line_no, row_no, record), where ``__block``
    is the split a record begins in, ``line_no`` its number in the file, and
    ``row_no`` its number among those that aren't blank (null for blank ones),
    and the split table (file, __block; total and rows of the file)."""
    from ..session import materialize

    pieces = _key(pieces)
    splits = materialize(_starts(_summaries(pieces, k), k, ends, unfinished))
    known = _key(splits).drop("file", "__block", "rows")
    ready = pieces.join(F.broadcast(known.select("__split", "start", "first_no", "first_row", "total", "tail")), "__split").select(
        "file", "__block", "__split", "piece", "moves", "blank", "start", "first_no", "first_row", "total", "tail")

    def task(batches):
        import pyarrow as pa

        names = ["file", "__block", "line_no", "row_no", "record"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        split, held = None, None
        state = no = row = total = 0
        crosses = blank_so_far = False

        def closed():
            """The record held, as a row."""
            nonlocal no, row, held
            void = no >= total
            out = [] if void else [(*split, no, None if blank_so_far else row, b"\n".join(held))]
            no, row, held = no + 1, row + (not blank_so_far), None
            return out

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            out = []
            for file, block, first, size, moves in _runs(batch, k):
                if (file, block) != split:
                    if held is not None and not crosses:
                        out += closed()
                    # Pieces of a record that began in an earlier split are not held.
                    split, held = (file, block), None
                    state, no, row, total = (batch.column(c)[first].as_py() for c in ("start", "first_no", "first_row", "total"))
                    crosses = batch.column("tail")[first].as_py() is not None
                begins, state = _follow(moves, state, k)
                blank = batch.column("blank").slice(first, size).to_numpy(zero_copy_only=False)
                for begin, empty, piece in zip(begins.tolist(), blank.tolist(), batch.column("piece").slice(first, size).to_pylist()):
                    if begin:
                        if held is not None:
                            out += closed()
                        held, blank_so_far = [piece], empty
                    elif held is not None:
                        held.append(piece)
                        blank_so_far = False
            if out:
                yield batch_of(out)
        if held is not None and not crosses:
            out = closed()
            if out:
                yield batch_of(out)

    records = ready.mapInArrow(task, "file string, __block bigint, line_no bigint, row_no bigint, record binary")
    cut = known.where("head_end IS NOT NULL OR tail IS NOT NULL")
    if not cut.isEmpty():
        # Records that cross splits: their pieces by place, under the record's split and numbers.
        def record(block, no, row):
            return F.struct(block.alias("block"), no.alias("no"), row.alias("row"))

        c = F.col
        of = F.when(c("__mid") <= c("head_end"), record(c("opened"), c("opened_no"), c("opened_row"))).when(
            c("__mid") >= c("tail"), record(c("__block"), c("first_no") + c("n") - 1, c("first_row") + c("filled") - 1))
        found = pieces.join(F.broadcast(cut), "__split").withColumn("of", of).where("of IS NOT NULL")
        found = found.groupBy("file", "of").agg(F.array_sort(F.collect_list(F.struct("__block", "__mid", "piece"))).alias("parts"))
        joined = F.aggregate(F.slice("parts", 2, F.size("parts")), c("parts")[0]["piece"],
                             lambda all_, p: F.concat(all_, F.lit(bytearray(b"\n")), p["piece"]))
        records = records.unionByName(found.select("file", c("of.block").alias("__block"), c("of.no").alias("line_no"),
                                                   c("of.row").alias("row_no"), joined.alias("record")))
    return records, splits.select("file", "__block", "total", "rows")


def file_bases(splits: DataFrame) -> DataFrame:
    """file, base: the records of all files before it by name (a row per file)."""
    w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.max("total").alias("total"))
    return files.select("file", F.coalesce(F.sum("total").over(w), F.lit(0)).alias("base"))
