"""Operator 5, scoring texts with a Brown class-based bigram model.

A word's probability is that of its class after the class of the word before
it, times that of the word within its class.

* *Counts.* Words of all training texts are counted, with a partial count in
  each task.
* *Codes.* A pass writes every training text as the places of its words in the
  dictionary (the ``DICTIONARY`` most frequent words), or their endings, which later passes
  over the training texts read.
* *First classes.* Exchange clustering moves units: each of the ``WORDS`` most
  frequent words is one, every other word belongs to the unit of its ending (a
  hash of its last two bytes, ``ENDINGS`` units). One pass counts all neighbouring
  units of the training texts into a table of at most (WORDS + ENDINGS + 1)
  squared cells, and sweeps move each unit to the class with the greatest
  likelihood, until none moves; the table has a fixed bound, so this runs on the
  driver. There are more classes the more tokens there are.
* *Classes of words.* Then each word of the dictionary (``DICTIONARY`` most
  frequent) is exchanged by itself, ``WORD_SWEEPS`` times: a pass counts the
  classes before and after every word, tasks add these up for blocks of words and
  move each to its best class, and the next pass counts the classes that follow
  each other (and the neighbours again). A sweep that lowers the likelihood is taken back. Words that are in
  no dictionary, unseen ones too, have the class of their ending.
* *Scores.* A text's classes are known in its task. The counts of the
  ``DICTIONARY`` most frequent words are sent to the tasks (a documented bound);
  those of the others are joined by word, as (document, word, times) rows.

Defined results: null text is empty and has the end token alone; a null id is
held out; rows that repeat an id are scored each for itself; without training
texts every count is zero; an empty table gives no rows; a text of any length is
scored whole by one task; further columns are not looked at. Words are compared
as UTF-8 bytes with A-Z in lower case."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, exact, slices, texts

WORDS = 1024
ENDINGS = 128
#: Classes of a corpus of a few words; see ``class_count``.
CLASSES = 48
SWEEPS = 12
WORD_SWEEPS = 2
#: Words whose neighbours one task adds up at once.
BLOCK = 256
DICTIONARY = 100_000
ALPHA = 0.1
#: Weight of the classes' own frequencies against the classes that follow.
BETA = 20.0
#: Words that a worker counts before it passes them on.
HELD = 120_000
END = b""  # stands for the end token; no word is empty


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def _line(sizes: list[int], codes: np.ndarray, end: int) -> np.ndarray:
    """The codes of texts' words, one text after the other, with ``end`` before, between and after them."""
    line = np.full(len(codes) + len(sizes) + 1, end, np.int64)
    line[np.arange(len(codes)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)] = codes
    return line


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) of the training texts, the end token included."""

    def task(batches):
        import pyarrow as pa

        def rows(table):
            return pa.RecordBatch.from_arrays([pa.array(list(table), pa.binary()), pa.array(list(table.values()), pa.int64())], ["word", "c"])

        table: Counter = Counter()
        for piece in slices(batches):
            for text in texts(piece.column("text")):
                table.update(text.lower().split())
                table[END] += 1
            if len(table) > HELD:
                yield rows(table)
                table.clear()
        yield rows(table)

    part = docs.where("NOT held_out").select("text").mapInArrow(task, "word binary, c bigint")
    return part.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words and their counts, ``most`` at the most: those
    above a count that a small table of counts by size class tells (sixteen
    classes for each doubling), so that no task sorts a share of all words."""
    size = F.floor(F.log2("c") * 16)
    classes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    room, taken = most, F.lit(False)
    for r in classes:
        if r["n"] > room:
            # Words of one size that don't all fit: those whose hash is low.
            low = F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < F.lit(int((1 << 31) * room / r["n"]))
            taken = taken | ((size == r["size"]) & low)
            break
        room -= r["n"]
        taken = size >= r["size"]
    got = counts.where(taken).toArrow()
    words, n = got.column("word").to_pylist(), got.column("c").to_numpy().astype(float)
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))[:most]
    return [words[i] for i in order], n[order]


def encode_texts(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """(codes) of each training text, written, so that later passes look no word up
    again: for a word of the dictionary its place, for another the dictionary's
    length and the word's ending, as 32-bit integers."""
    shared, run = docs.sparkSession.sparkContext.broadcast(words), uuid.uuid4().hex

    def task(batches):
        import pyarrow as pa

        words = shared.value
        at = _dictionary(run, words)
        for piece in slices(batches):
            lists = [text.lower().split() for text in texts(piece.column("text"))]
            place = _places(list(chain.from_iterable(lists)), at, len(words)).astype("<i4")
            cuts = np.cumsum([0] + [len(x) for x in lists]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([place[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())], ["codes"])

    coded = materialize(docs.where("NOT held_out").select("text").mapInArrow(task, "codes binary"))
    shared.destroy()
    return coded


def _places(tokens: list[bytes], at: dict[bytes, int], n: int) -> np.ndarray:
    """The places of words, for those outside of the dictionary n and their ending."""
    place = np.fromiter(map(at.get, tokens, repeat(-1)), np.int64, len(tokens))
    other = np.flatnonzero(place < 0)
    place[other] = np.fromiter((n + ending(tokens[i]) for i in other.tolist()), np.int64, len(other))
    return place


def _codes(piece) -> tuple[list[int], np.ndarray]:
    """The sizes of encoded texts and their codes, one text after the other."""
    got = piece.column("codes").to_pylist()
    return [len(x) // 4 for x in got], np.frombuffer(b"".join(got), "<i4")


def count_unit_pairs(coded: DataFrame, words: list[bytes], most: int) -> np.ndarray:
    """How often each unit follows each other unit in the training texts; the
    ``most`` first words are units, others go by their ending, and the
    last unit is the end token, which also stands before the first word."""
    first_ending, n = min(most, len(words)), min(most, len(words)) + ENDINGS + 1
    unit_of = np.array([*range(first_ending), *(first_ending + ending(w) for w in words[first_ending:]), *range(first_ending, n - 1)], np.int64)

    def task(batches):
        import pyarrow as pa

        cells = np.zeros(n * n, np.int64)
        for piece in slices(batches, text_col="codes"):
            sizes, codes = _codes(piece)
            line = _line(sizes, unit_of[codes], n - 1)
            cells += np.bincount(line[:-1] * n + line[1:], minlength=n * n)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], ["cell", "n"])

    got = coded.mapInArrow(task, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(n * n)
    pairs[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return pairs.reshape(n, n)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit. The last unit keeps a class of its own; the
    others begin in turn by frequency and move while the likelihood grows."""
    n = len(pairs)
    order = np.argsort(-pairs[:-1].sum(1), kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = np.arange(n - 1) % classes
    of[-1] = classes
    table = class_table(pairs, of, classes + 1)
    xlogx = lambda x: x * np.log(np.maximum(x, 1.0))
    for _ in range(sweeps):
        moved = 0
        for u in order.tolist():
            own = pairs[u, u]
            right = np.bincount(of, pairs[u], classes + 1)
            left = np.bincount(of, pairs[:, u], classes + 1)
            a = of[u]
            right[a] -= own
            left[a] -= own
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= own
            # Sums of the classes with their steps to and from the unit, wherever it goes.
            rows, cols = table.sum(1) + left, table.sum(0) + right
            gain = (xlogx(table + right) - xlogx(table)).sum(1) + (xlogx(table.T + left) - xlogx(table.T)).sum(1)
            own_cell = table.diagonal()
            gain += (xlogx(own_cell + right + left + own) - xlogx(own_cell + right) - xlogx(own_cell + left) + xlogx(own_cell))
            gain -= xlogx(rows + right.sum() + own) - xlogx(rows) + xlogx(cols + left.sum() + own) - xlogx(cols)
            best = int(gain[:classes].argmax())
            if gain[best] <= gain[a] + 1e-9:
                best = a
            moved += best != a
            of[u] = best
            table[best] += right
            table[:, best] += left
            table[best, best] += own
        if not moved:
            break
    return of


def class_table(pairs: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    member = np.zeros((len(of), classes))
    member[np.arange(len(of)), of] = 1
    return member.T @ pairs @ member


def class_count(tokens: int) -> int:
    """Classes for a corpus of so many tokens: twice its fifth root, 48 at least."""
    return max(CLASSES, int(2 * tokens ** 0.2))


def likelihood(follow: np.ndarray) -> float:
    """What of the training texts' log-likelihood depends on the classes."""
    f = lambda x: float((x * np.log(np.maximum(x, 1.0))).sum())
    return f(follow) - f(follow.sum(0)) - f(follow.sum(1))


def best_classes(before: np.ndarray, after: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """The class of each word (row) with the greatest likelihood, the classes of
    all others as they are: ``before`` and ``after`` have how often each class
    stands there, ``follow`` how often classes follow each other."""
    step = np.log(follow + 0.5)
    seen = np.log(follow.sum(1) + 0.5) + np.log(follow.sum(0) + 0.5)
    score = before @ step + after @ step.T - before.sum(1, keepdims=True) * seen
    return score[:, :-1].argmax(1)


def count_neighbours(docs: DataFrame, words: list[bytes], class_of: np.ndarray, of_ending: np.ndarray, end: int, around_words: bool) -> DataFrame:
    """One pass over the training texts under the given classes: (block, cells,
    counts), how often classes follow class c (block -1 - c) and, if asked for, how
    often each class stands before and after the dictionary's words, by blocks of
    words. Written, so that both are read from one pass. The end token's class is
    ``end``, the last. ``docs`` has the texts, or what ``encode_texts`` made of them."""
    coded = docs if "codes" in docs.columns else encode_texts(docs, words)
    n, classes = len(words), end + 1
    shared = docs.sparkSession.sparkContext.broadcast(np.r_[class_of, of_ending].astype(np.int64))

    def task(batches):
        import pyarrow as pa

        table = np.zeros(classes * classes, np.int64)
        around = np.zeros(n * 2 * classes if around_words else 0, np.int32)
        for piece in slices(batches, text_col="codes"):
            sizes, codes = _codes(piece)
            line = _line(sizes, shared.value[codes], end)
            table += np.bincount(line[:-1] * classes + line[1:], minlength=len(table))
            if around_words:
                # Words by their places in the line, between what stands before and after them.
                place = _line(sizes, np.where(codes < n, codes, -1), -1)
                known = np.flatnonzero(place >= 0)
                first = place[known] * (2 * classes)
                cell, count = np.unique(np.concatenate([first + line[known - 1], first + classes + line[known + 1]]), return_counts=True)
                around[cell] += count.astype(np.int32)
        rows = [(-1 - c, np.flatnonzero(row), row[row > 0]) for c, row in enumerate(table.reshape(classes, classes)) if row.any()]
        cell = np.flatnonzero(around)
        cuts = np.searchsorted(cell, np.arange(0, len(around) + 1, BLOCK * 2 * classes)).tolist() + [len(cell)]
        rows += [(b, cell[i:j] - b * BLOCK * 2 * classes, around[cell[i:j]]) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in rows], pa.int32()), pa.array([c.astype("<i4").tobytes() for _, c, _ in rows], pa.binary()),
             pa.array([m.astype("<i8" if b < 0 else "<i4").tobytes() for b, _, m in rows], pa.binary())], ["block", "cells", "counts"])

    found = materialize(coded.mapInArrow(task, "block int, cells binary, counts binary"))
    shared.destroy()
    return found


def class_pairs(found: DataFrame, end: int) -> np.ndarray:
    """How often classes follow each other, added up class by class in tasks."""

    def task(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "counts"))):
                sums.setdefault(b, np.zeros(end + 1, np.int64))[np.frombuffer(cells, "<i4")] += np.frombuffer(counts, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))],
                                         ["block", "row"])

    table = np.zeros((end + 1, end + 1))
    for r in found.where("block < 0").repartition("block").mapInArrow(task, "block int, row array<bigint>").collect():
        table[-1 - r["block"]] = r["row"]
    return table


def moved_words(found: DataFrame, class_of: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """The best class of each dictionary word, found block by block in tasks."""
    classes = len(follow)

    def task(batches):
        import pyarrow as pa

        def done(block, total):
            some = total.reshape(-1, 2, classes).astype(float)
            where = np.flatnonzero(some.sum((1, 2)))
            value = best_classes(some[where, 0], some[where, 1], follow)
            return pa.RecordBatch.from_arrays([pa.array(where + block * BLOCK, pa.int64()), pa.array(value, pa.int64())], ["at", "value"])

        block, total = None, None
        for batch in batches:
            for b, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "counts"))):
                if b != block:
                    if block is not None:
                        yield done(block, total)
                    block, total = b, np.zeros(BLOCK * 2 * classes, np.int64)
                total[np.frombuffer(cells, "<i4")] += np.frombuffer(counts, "<i4")
        if block is not None:
            yield done(block, total)

    got = found.where("block >= 0").repartition("block").sortWithinPartitions("block").mapInArrow(task, "at bigint, value bigint").toArrow()
    moved = class_of.copy()
    moved[got.column("at").to_numpy()] = got.column("value").to_numpy()
    return moved


def _dictionary(run: str, words: list[bytes]) -> dict[bytes, int]:
    """A worker's places of the dictionary's words."""
    at = _DICTIONARIES.get(run)
    if at is None:
        _DICTIONARIES.clear()
        at = _DICTIONARIES[run] = {w: i for i, w in enumerate(words)}
    return at


def fit_classes(docs: DataFrame, counts: DataFrame, n_train: int):
    """The dictionary and its counts, the classes of its words and of endings,
    and how often classes follow each other in the training texts."""
    words, word_counts = frequent_words(counts, DICTIONARY)
    unit_of = {w: i for i, w in enumerate(words[:WORDS])}
    first_ending, n_classes = len(unit_of), class_count(n_train)
    coded = encode_texts(docs, words)
    pairs = count_unit_pairs(coded, words, WORDS)
    of = exchange(pairs, n_classes)
    follow = class_table(pairs, of, n_classes + 1)
    ending_class = of[first_ending : first_ending + ENDINGS]
    word_class = np.array([of[unit_of[w]] if w in unit_of else ending_class[ending(w)] for w in words], np.int64)
    sweeps = WORD_SWEEPS if words else 0
    found = count_neighbours(coded, words, word_class, ending_class, n_classes, True) if sweeps else None
    for i in range(sweeps):
        moved = moved_words(found, word_class, follow)
        if (moved == word_class).all():
            break
        # What follows what under the new classes, and the words' neighbours for the next sweep.
        found = count_neighbours(coded, words, moved, ending_class, n_classes, i + 1 < sweeps)
        after = class_pairs(found, n_classes)
        if likelihood(after) <= likelihood(follow):
            break
        word_class, follow = moved, after
    return words, word_counts, word_class, ending_class, follow


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    spark = df.sparkSession
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col).withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(0)) == 0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = materialize(count_words(docs))
    of_ending = F.crc32(F.substring("word", -2, 2)) % ENDINGS
    is_end = F.length("word") == 0
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(is_end, F.col("c"))).alias("ends")).first()
    n_train, n_distinct, n_ends = total["n"] or 0, total["v"] or 0, total["ends"] or 0

    words, word_counts, word_class, ending_class, follow = fit_classes(docs, counts.where(~is_end), n_train)
    n_classes = len(follow) - 1
    # Distinct words of a class: its own dictionary words and those of its endings.
    distinct = np.bincount(word_class, minlength=n_classes + 1) * 1.0
    distinct[n_classes] = 1 if n_ends else 0
    by_ending = {r["e"]: r["n"] for r in counts.where(~is_end).groupBy(of_ending.alias("e")).count().withColumnRenamed("count", "n").collect()}
    for w in words:
        by_ending[ending(w)] -= 1
    for e, n in by_ending.items():
        distinct[ending_class[e]] += n
    in_class = follow.sum(0)
    share = (in_class + 1) / (in_class.sum() + n_classes + 1)
    step = np.log10((follow + BETA * share) / (follow.sum(1, keepdims=True) + BETA))
    inside = np.log10(in_class + ALPHA * (distinct + 1))
    # Places: the dictionary's words, then the endings, then the end token.
    class_of = np.r_[word_class, ending_class, n_classes].astype(np.int64)
    log_count = np.r_[np.log10(word_counts + ALPHA), np.zeros(ENDINGS), np.log10(n_ends + ALPHA)]
    known = np.r_[np.ones(len(words), np.int64), np.zeros(ENDINGS, np.int64), int(n_ends > 0)]
    run = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((words, class_of, log_count, known, step, inside))

    def task(batches):
        import pyarrow as pa

        words, class_of, log_count, known, step, inside = shared.value
        at = _dictionary(run, words)
        n, end = len(words), len(class_of) - 1
        for piece in slices(batches):
            out, rare, rare_n = [], [], []
            lists = [text.lower().split() for text in texts(piece.column("text"))]
            tokens = list(chain.from_iterable(lists))
            place = _places(tokens, at, n)
            other = np.flatnonzero(place >= n)
            others = [tokens[i] for i in other.tolist()]
            line = _line([len(x) for x in lists], place, end)
            cls = class_of[line]
            steps, ins, logs, knowns = step[cls[:-1], cls[1:]], inside[cls[1:]], log_count[line[1:]], known[line[1:]]
            a = b = 0
            cuts = np.searchsorted(other, np.cumsum([0] + [len(x) for x in lists])).tolist()
            for words_of, i, j in zip(lists, cuts, cuts[1:]):
                a, b = b, b + len(words_of) + 1
                out.append((b - a, int(knowns[a:b].sum()), float(logs[a:b].sum()), float(steps[a:b].sum() - ins[a:b].sum())))
                each = Counter(others[i:j])
                rare.append(list(each))
                rare_n.append(list(each.values()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), *[pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                 pa.array(rare, pa.list_(pa.binary())), pa.array(rare_n, pa.list_(pa.int32()))],
                ["doc_id", "held_out", "n_tokens", "n_known", "counts", "classes", "rare", "rare_n"])

    scored = docs.mapInArrow(task, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, counts double, "
                                   "classes double, rare array<binary>, rare_n array<int>")
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()))  # written, so the numbers stay
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("times")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    more = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10(c + ALPHA)).alias("more"),
                                   F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"))
    whole = scored.drop("rare", "rare_n").join(more, "row", "left").withColumn("s", F.col("counts") + F.coalesce("more", F.lit(0.0)))
    norm = float(np.log10(n_train + ALPHA * (n_distinct + 1)))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("s") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("s") + F.col("classes")).alias("score"))


_DICTIONARIES: dict = {}
