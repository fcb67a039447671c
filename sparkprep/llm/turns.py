"""Repair of the turn structure of conversations (operator 11).

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``: nothing,
or perhaps a system turn and then user and assistant in turns. ``repair`` counts
each conversation's faults and finds the cheapest edits that make it sound:
keep a row (0), give it the role user or assistant (3), delete it (4; blank and
duplicate rows must go), insert an empty turn (3); a truncated row that stays
adds 3. Of the cheapest, the edits whose initials in order (the audit) are
ASCII-least.

There are four states: nothing yet, after s, after u, after a. For a run of rows,
``Run`` has the least cost from each state to each, and how the audits of the
four ways rank. Ways to different states never have audits of which one begins
the other (both have one letter for each row and end with one), so ranks of two
runs give those of the run of both, and no audit has to be kept to compare them.
``cross`` is Hirschberg's divide and conquer: forward vectors (cost, rank) and
backward costs meet in the middle, the audit-least of the best crossing states is
taken, and both halves are solved between their known end states, in space
linear in the rows.

On Spark: rows get their place by a range sort of digests, not texts, so a
conversation of any length is spread over tasks. Runs of ``RUN`` rows are
summarised in parallel; summaries are joined in runs of ``RUN`` again until one is
left for a conversation; crossings then go down the same levels, and each run
of rows is reconstructed by itself. Only the digest of the repaired text, which is
one hash over the whole conversation in order, is taken by one task per
conversation; it streams the rows in the order a sort gives and holds one batch.

Results for the cases at the edge: a null counts as one blank (``damage`` too; a
null conv_id is a conversation of its own and is returned as null, null turns come
first and count for no gap); rows of equal turn are ordered by role, then by the
SHA-256 of their text; repeated rows are duplicates; roles are compared by their
first character, an empty role has none and can't be kept; a conversation without
rows has zeros, an empty audit and the digest of the empty string; an empty
table gives no rows; further columns are not looked at."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD_CLASS, bounded_batches, exact
from .ordered import group_key, numbered

#: Rows, or runs, that one task solves at once.
RUN = 2048
INF = 1 << 40

NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Initial -> (state before, state after) of a row that is kept.
KEPT = {"s": ((NOTHING, AFTER_S),), "u": ((NOTHING, AFTER_U), (AFTER_S, AFTER_U), (AFTER_A, AFTER_U)), "a": ((AFTER_U, AFTER_A),)}
#: Turns to insert on the shortest way from state to state.
INSERTS = {(p, p): 0 for p in range(4)} | {(NOTHING, AFTER_U): 1, (NOTHING, AFTER_A): 2, (AFTER_S, AFTER_U): 1, (AFTER_S, AFTER_A): 2,
                                           (AFTER_U, AFTER_A): 1, (AFTER_A, AFTER_U): 1}
#: Turns to insert at the end of a conversation, by state.
AT_END = (0, 2, 1, 0)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3


class Run:
    """From each state p to each q: ``cost[p][q]``, and ``rank[p][q]``, the place
    of the least audit of that cost among those to the other states."""

    __slots__ = ("cost", "rank")

    def __init__(self, cost, rank):
        self.cost, self.rank = cost, rank

    def pack(self) -> list[int]:
        return [x for table in (self.cost, self.rank) for row in table for x in row]

    @classmethod
    def unpack(cls, numbers) -> "Run":
        rows = [list(numbers[i:i + 4]) for i in range(0, 32, 4)]
        return cls(rows[:4], rows[4:])


def row_edits(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, str]]]:
    """For one row, per state before and after: the least cost and audit."""
    out = [[(INF, "") for _ in range(4)] for _ in range(4)]
    for p in range(4):
        for mid in range(4):
            if (p, mid) not in INSERTS:
                continue
            n = INSERTS[p, mid]
            moves = [(mid, DELETE, "D")]
            if not must_go:
                extra = TRUNCATED if truncated else 0
                moves += [(q, KEEP + extra, "K") for b, q in KEPT.get(initial, ()) if b == mid]
                moves += [(q, REROLE + extra, "R") for i in "ua" for b, q in KEPT[i] if b == mid]
            for q, cost, letter in moves:
                out[p][q] = min(out[p][q], (cost + INSERT * n, "I" * n + letter))
    return out


#: The kinds of rows: initial (or ``-`` for another), then k, t (truncated) or d (must go).
EDITS = {i + f: row_edits(i, f == "d", f == "t") for i in "sua-" for f in "ktd"}


def _ranks(keys: list) -> list[int]:
    order = sorted(range(4), key=keys.__getitem__)
    out = [0] * 4
    for place, q in enumerate(order):
        out[q] = place
    return out


ROWS = {k: Run([[c for c, _ in row] for row in e], [_ranks([(c == INF, a) for c, a in row]) for row in e]) for k, e in EDITS.items()}


def step(cost: list[int], rank: list[int], run: Run) -> tuple[list[int], list[int]]:
    """Forward vectors after the run: per state the least cost and the audit's rank."""
    best = [INF] * 4
    keys: list = [(4, q) for q in range(4)]
    for q in range(4):
        for b in range(4):
            c = cost[b] + run.cost[b][q]
            if c < best[q] or (c == best[q] < INF and rank[b] < keys[q][0]):
                best[q], keys[q] = c, (rank[b], run.rank[b][q])
    return best, _ranks(keys)


def before(run: Run, cost: list[int]) -> list[int]:
    """Backward costs before the run from those after it."""
    return [min(INF, min(run.cost[p][q] + cost[q] for q in range(4))) for p in range(4)]


def start(p: int) -> tuple[list[int], list[int]]:
    return [0 if q == p else INF for q in range(4)], [(q - p) % 4 for q in range(4)]


def join(runs: list[Run]) -> Run:
    """The run of several in a row."""
    cost, rank = [], []
    for p in range(4):
        c, r = start(p)
        for run in runs:
            c, r = step(c, r, run)
        cost.append(c)
        rank.append(r)
    return Run(cost, rank)


def last_state(run: Run) -> int:
    """The state in which the audit-least cheapest way through a whole conversation ends, inserts at its end aside."""
    total = [run.cost[NOTHING][q] + INSERT * AT_END[q] for q in range(4)]
    return min(range(4), key=lambda q: (total[q], run.rank[NOTHING][q]))


def cross(runs: list[Run], p: int, q: int) -> list[tuple[int, int]]:
    """The states before and after each run on the audit-least cheapest way from p to q."""
    out: list = [(p, q)] * len(runs)
    work = [(0, len(runs), p, q)]
    while work:
        low, high, p, q = work.pop()
        if high - low <= 1:
            if high > low:
                out[low] = (p, q)
            continue
        middle = (low + high) // 2
        forward, rank = start(p)
        for run in runs[low:middle]:
            forward, rank = step(forward, rank, run)
        backward = start(q)[0]
        for run in reversed(runs[middle:high]):
            backward = before(run, backward)
        c = min(range(4), key=lambda s: (forward[s] + backward[s], rank[s]))
        work += [(low, middle, p, c), (middle, high, c, q)]
    return out


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text after a fixed damage: by the CRC-32 of
    ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 takes its
    ``.!?`` out, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    rows = exact(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("__do", F.crc32(name.cast("binary")) % 20).where("__do <> 0")
    text, do = F.coalesce("text", blank), F.col("__do")
    return rows.select(
        "conv_id", "turn", F.when(do == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(do == 1, F.lit("")).when(do == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(do == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


def _last_visible(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def _in_runs(df: DataFrame, what: Column, at: str) -> DataFrame:
    """g, block, and ``what`` of a run's members in order."""
    of = F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), what.alias("x"))))
    return df.groupBy("g", F.expr(f"{at} div {RUN}").alias("block")).agg(F.transform(of, lambda s: s["x"]).alias("members"))


def _summaries(runs: DataFrame, of_rows: bool) -> DataFrame:
    """g, pos, run (packed) for each run of rows (by kind) or of packed runs."""

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for members in batch.column("members").to_pylist():
                out.append(join([ROWS[m] if of_rows else Run.unpack(m) for m in members]).pack())
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("block"), pa.array(out, pa.list_(pa.int64()))],
                                             ["g", "pos", "run"])

    return runs.mapInArrow(task, "g string, pos bigint, run array<bigint>")


def _ways(level: DataFrame) -> DataFrame:
    """For runs (g, pos, run) of whole conversations: the states (p, q) before
    and after each. Runs of runs are solved first, as long as there are several."""
    above = materialize(_summaries(_in_runs(level, F.col("run"), "pos"), False))
    if (above.agg(F.max("pos")).first()[0] or 0) > 0:
        ends = _ways(above)
    else:
        ends = above.select("g", "pos", _ends(F.col("run")).alias("pq")).select("g", "pos", "pq.*")
    members = _in_runs(level, F.col("run"), "pos").join(ends.withColumnRenamed("pos", "block"), ["g", "block"])

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            g, pos, ps, qs = [], [], [], []
            for name, block, runs, p, q in zip(*(batch.column(c).to_pylist() for c in ("g", "block", "members", "p", "q"))):
                for i, (a, b) in enumerate(cross([Run.unpack(r) for r in runs], p, q)):
                    g.append(name)
                    pos.append(block * RUN + i)
                    ps.append(a)
                    qs.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(pos, pa.int64()), pa.array(ps, pa.int32()),
                                              pa.array(qs, pa.int32())], ["g", "pos", "p", "q"])

    return materialize(members.mapInArrow(task, "g string, pos bigint, p int, q int"))


def _ends(run: Column) -> Column:
    """The states at the ends of a conversation's one run, as ``last_state`` has them."""
    options = [F.struct((run[NOTHING * 4 + q] + INSERT * AT_END[q]).alias("cost"), run[16 + NOTHING * 4 + q].alias("rank"),
                        F.lit(q).alias("q")) for q in range(4)]
    best = F.array_min(F.array(*options))
    return F.struct(F.lit(NOTHING).alias("p"), best["q"].alias("q"))


def _pieces(runs: DataFrame) -> DataFrame:
    """g, block, audit (of the run's rows), cost, q for runs with their end states."""

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            audits, costs = [], []
            for kinds, p, q in zip(*(batch.column(c).to_pylist() for c in ("members", "p", "q"))):
                edits = [EDITS[k][a][b] for k, (a, b) in zip(kinds, cross([ROWS[k] for k in kinds], p, q))]
                audits.append("".join(a for _, a in edits))
                costs.append(sum(c for c, _ in edits))
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("block"), pa.array(audits, pa.string()),
                                              pa.array(costs, pa.int64()), batch.column("q")], ["g", "block", "audit", "cost", "q"])

    return runs.mapInArrow(task, "g string, block bigint, audit string, cost bigint, q int")


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """g, repaired_sha256: each conversation's rows streamed in order under its audit."""
    stream = (rows.select("g", F.lit(1).alias("__k"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
              .unionByName(audits.select("g", F.lit(0).alias("__k"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                                         F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"))))
    order = ["g", "__k", F.col("turn").asc_nulls_first(), "role", "digest"]
    stream = stream.repartition("g").sortWithinPartitions(*order).select("g", "__k", "role", "text")

    def task(batches):
        import pyarrow as pa

        g, repair = None, None
        for batch in batches:
            done = []
            for name, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("g", "__k", "role", "text"))):
                if kind == 0:
                    if repair is not None:
                        done.append((g, repair.digest()))
                    g, repair = name, Repair(text)
                else:
                    repair.row(role, text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["g", "repaired_sha256"])
        if repair is not None:
            yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([repair.digest()])], ["g", "repaired_sha256"])

    bounded_batches(rows)
    return stream.mapInArrow(task, "g string, repaired_sha256 string")


class Repair:
    """Applies an audit to rows as they come, into a digest of the repaired rows."""

    #: What comes after a role: its initial and the role that is inserted or given there.
    NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def __init__(self, audit: str, sink=None):
        self.audit, self.at, self.last = audit, 0, ""
        self.sha, self.empty = sink or hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.last, self.empty = role[0], False

    def _inserts(self) -> None:
        while self.audit.startswith("I", self.at):
            self._put(self.NEXT[self.last], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._put(role if letter == "K" else self.NEXT[self.last], text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def repair(given: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 per conversation of ``given``, or of ``conversations``, a
    table that also has the ids of conversations without any rows left."""
    blank = F.lit(" ")
    rows = exact(given, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.select(group_key(F.col("conv_id")).alias("g"), "turn", F.coalesce("role", blank).alias("role"),
                       F.coalesce("text", blank).alias("text"))
    word = F.col("text").rlike(WORD_CLASS)
    keys = rows.select("g", "turn", "role", F.sha2("text", 256).alias("digest"), (~word).alias("blank"),
                       (word & ~_last_visible(F.col("text")).isin(".", "!", "?")).alias("cut"))
    placed = numbered(keys, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")])

    # The first row of each role and text; all others repeat it.
    firsts = placed.groupBy("g", "role", "digest").agg(F.min("pos").alias("pos")).select("g", "pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated"))
    typed = placed.join(firsts, ["g", "pos"], "left").select("g", "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    flag = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", "t").otherwise("k")
    kind = F.concat(F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-"), flag)
    typed = materialize(typed.withColumn("kind", kind))

    counted = typed.groupBy("g").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])

    # Runs of rows, up to whole conversations and down again.
    in_runs = materialize(_in_runs(typed, F.struct("kind", "initial"), "pos"))
    runs = in_runs.select("g", "block", F.col("members.kind").alias("members"))
    ends = _ways(materialize(_summaries(runs, True))).withColumnRenamed("pos", "block")
    pieces = materialize(_pieces(runs.join(ends, ["g", "block"])))
    in_order = F.array_sort(F.collect_list(F.struct("block", "audit", "q")))
    joined = pieces.groupBy("g").agg(in_order.alias("parts"), F.sum("cost").alias("cost"))
    inserts = F.element_at(F.array(*map(F.lit, AT_END)), F.element_at("parts", -1)["q"] + 1)
    joined = materialize(joined.select(
        "g", F.concat(F.array_join("parts.audit", ""), F.repeat(F.lit("I"), inserts)).alias("audit"),
        (F.col("cost") + INSERT * inserts).alias("cost")))

    pairs = F.expr("aggregate(sequence(1, size(members) - 1), 0L, (n, i) -> n + int(concat(members[i - 1].initial, members[i].initial) "
                   "not in ('su', 'ua', 'au')))")
    w = Window.partitionBy("g").orderBy("block")
    edges = in_runs.select("g", "block", F.when(F.size("members") > 1, pairs).otherwise(F.lit(0)).alias("within"),
                           F.col("members")[0]["initial"].alias("head"), F.element_at("members", -1)["initial"].alias("tail"))
    across = F.concat(F.lag("tail").over(w), F.col("head"))
    illegal = (edges.withColumn("across", F.coalesce((~across.isin("su", "ua", "au")).cast("bigint"), F.lit(0)))
               .groupBy("g").agg(F.sum(F.col("within") + F.col("across")).cast("bigint").alias("illegal")))

    found = counted.join(illegal, "g").join(joined, "g").join(_digests(rows, joined), "g")
    ids = exact(given if conversations is None else conversations, conv_id=conv_col).distinct()
    ids = ids.withColumn("g", group_key(F.col("conv_id")))
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return ids.join(found, "g", "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
