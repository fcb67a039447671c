"""Operator 10, substring dedup with prefix-partitioned suffix trees.

A window of ``WINDOW`` words is removed from a document if the same words in
the same order also start in a document with a smaller id.

*Prefixes.* Every window is filed under one of the word sequences of ``PREFIX``
words in it, the one with the least hash (of equals the last). Equal windows
choose the same sequence at the same place, so they meet under its hash, and
neighbouring windows mostly share one: a document has about two such prefixes
for ``WINDOW - PREFIX + 1`` windows. Only prefixes that two documents have go
on; the others' windows can't repeat.

*Trees.* The windows under one prefix are the suffixes of one subtree: what
follows the prefix is sorted, and the common lengths of neighbours in that order
are the depths of the subtree's internal nodes; what stands before it, read
backwards, is a second such tree. For each place of the prefix in a window, a
node of the first tree and one of the second, together ``WINDOW`` words deep,
hold just the documents that share a window, and all but those with the
smallest id lose it. Words are compared, not hashes.

*Sizes.* A task takes the subtrees of some ten thousand rows at a time. A prefix
that more than ``HOT`` documents have would not fit; it is lengthened to whole
windows, whose digests are spread over all tasks and combined before the shuffle.

Documents with the same words as one with a smaller id lose all words (from
``WINDOW`` words on) and take no part in the trees: the first one has all their
windows.

Defined results: null counts as empty; a null id comes after all others, and
rows with the same id (null too) don't remove each other's words; ids that are
no integers are ranked in their own order; documents below ``WINDOW`` words keep
all; a text of any length is split into words by one task, but its windows go to
many; an empty table gives no rows; further columns are not looked at."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CLASS, bounded_batches, exact, slices, texts
from .ordered import numbered

WINDOW = 50
PREFIX = 8
HOT = 1_000
ROWS = 20_000
REMEMBERED = 400_000
LAST = (1 << 63) - 1
PLACE = np.uint64((1 << 28) - 1)
ODD = 0x9E3779B97F4A7C15


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(name: str, factor: int, n: int) -> np.ndarray:
    have = _POWERS[name]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(factor, len(have), 1 << 64))])
    _POWERS[name] = have
    return have[:n]


def prefixes(words: list[bytes], window: int = WINDOW, prefix: int = PREFIX):
    """For each window of the text the place of its prefix, and the hashes of
    all sequences of ``prefix`` words."""
    n = len(words)
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    # A polynomial hash of each sequence from one running sum, modulo 2**64.
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * _powers("down", pow(ODD, -1, 1 << 64), n))])
    h = (total[prefix:] - total[:-prefix]) * _powers("up", ODD, n - prefix + 1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    least, have, span = (h & ~PLACE) | (PLACE - np.arange(len(h), dtype=np.uint64)), 1, window - prefix + 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (PLACE - (least & PLACE)).astype(np.int64), h.view(np.int64)


def _first_pass(window: int, prefix: int):
    """Counts, a digest of the words, and the distinct prefixes of each document."""

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            n_words, digests, hashes = [], [], []
            for text in texts(piece.column("text")):
                words = text.split()
                n_words.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                if len(words) >= window:
                    place, h = prefixes(words, window, prefix)
                    hashes.append(np.unique(h[place]))
                else:
                    hashes.append(np.empty(0, np.int64))
            at = np.cumsum([0, *map(len, hashes)])
            yield pa.RecordBatch.from_arrays(
                [piece.column("rid"), piece.column("doc_id"), piece.column("ord"), pa.array(n_words, pa.int64()),
                 pa.array(digests, pa.binary()), pa.LargeListArray.from_arrays(at, np.concatenate(hashes)).cast(pa.list_(pa.int64()))],
                ["rid", "doc_id", "ord", "n_words", "sha", "hashes"])

    return task


def _stretches(text: bytes, wanted: set, window: int, prefix: int):
    """(hash, place of the prefix in the stretch, words of the stretch): starts,
    for the stretches of windows with a wanted prefix; equal ones together."""
    words = text.split()
    place, h = prefixes(words, window, prefix)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    found: dict = {}
    for s, e, p in zip(first.tolist(), last.tolist(), place[first].tolist()):
        key = int(h[p])
        if key in wanted:
            found.setdefault((key, p - s, b" ".join(words[s : e + window])), []).append(s)
    return found


def _emit(window: int, prefix: int):
    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            rows = []
            columns = (piece.column(c).to_pylist() for c in ("rid", "ord", "cold"))
            for text, rid, ord_, cold in zip(texts(piece.column("text")), *columns):
                for (key, at, part), starts in _stretches(text, set(cold), window, prefix).items():
                    rows.append((key, rid, ord_, at, part, starts))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()))
            names = ["key", "rid", "ord", "at", "part", "starts"]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return task


def _classes(matrix: np.ndarray):
    """The rows sorted word by word: their order, and the depth that each
    shares with the one before (the internal nodes of the tree)."""
    flat = np.ascontiguousarray(matrix.astype(">u4")).view(f"S{4 * matrix.shape[1]}").ravel()
    order = np.argsort(flat, kind="stable")
    differ = matrix[order][1:] != matrix[order][:-1]
    depth = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return order, np.r_[-1, depth]


def _at_depth(order, depth, d) -> np.ndarray:
    node = np.empty(len(order), np.int64)
    node[order] = np.cumsum(depth < d)
    return node


def shared_windows(keys, ords, ats, parts, window: int, prefix: int) -> np.ndarray:
    """(rows, windows) true where a row's window has a row with a smaller id;
    column ``a`` is the window with ``a`` words before the prefix."""
    n, before = len(keys), window - prefix + 1
    number: dict[bytes, int] = {}
    ids = [[number.setdefault(w, len(number) + 1) for w in part.split(b" ")] for part in parts]
    after, back = np.zeros((n, window + 1), np.uint32), np.zeros((n, before), np.uint32)
    after[:, 0] = back[:, 0] = np.unique(keys, return_inverse=True)[1]
    size = np.fromiter(map(len, ids), np.int64, n)
    for i, (row, at) in enumerate(zip(ids, ats)):
        right, left = row[at : at + window], row[max(0, at - before + 1) : at][::-1]
        after[i, 1 : 1 + len(right)] = right
        back[i, 1 : 1 + len(left)] = left
    ats = np.asarray(ats)
    tree, mirror = _classes(after), _classes(back)
    out = np.zeros((n, before), bool)
    for a in range(before):
        # The row has this window: its start lies in the stretch, and its end too.
        has = np.flatnonzero((ats >= a) & (size - ats >= window - a))
        if len(has) < 2:
            continue
        node = _at_depth(*tree, window - a + 1)[has] * (n + 1) + _at_depth(*mirror, a + 1)[has]
        order = np.argsort(node, kind="stable")
        run = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])
        least = np.repeat(np.minimum.reduceat(ords[has][order], run), np.diff(np.r_[run, len(order)]))
        out[has[order], a] = ords[has][order] > least
    return out


def _spans(rids, ats, starts, flags, window):
    """(rid, start, end) of the words that flagged windows cover."""
    import pyarrow as pa

    out = ([], [], [])
    for i in np.flatnonzero(flags.any(1)).tolist():
        a = np.flatnonzero(flags[i])
        cut = np.flatnonzero(np.diff(a) > 1)
        for low, high in zip(a[np.r_[0, cut + 1]].tolist(), a[np.r_[cut, len(a) - 1]].tolist()):
            for s in starts[i]:
                out[0].append(rids[i])
                out[1].append(s + ats[i] - high)
                out[2].append(s + ats[i] - low + window)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
                                      ["rid", "start", "end"])


def _trees(window: int, prefix: int, rows: int = ROWS):
    """Rows sorted by key, some ten thousand at a time, subtrees whole."""

    def task(batches):
        import pyarrow as pa

        def work(table):
            rids, ats, starts = (table.column(c).to_pylist() for c in ("rid", "at", "starts"))
            flags = shared_windows(table.column("key").to_numpy(), table.column("ord").to_numpy(), ats,
                                   table.column("part").to_pylist(), window, prefix)
            return _spans(rids, ats, starts, flags, window)

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) >= rows:
                keys = held.column("key").to_numpy()
                last = int(np.searchsorted(keys, keys[-1]))  # the last subtree may go on
                if last:
                    yield work(held.slice(0, last))
                    held = held.slice(last).combine_chunks()
        if held is not None and len(held):
            yield work(held)

    return task


def _whole_windows(window: int, prefix: int):
    """Digests of the windows under prefixes that very many documents have."""

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches, 1 << 18):
            rids, ords, digests, starts = [], [], [], []
            columns = (piece.column(c).to_pylist() for c in ("rid", "ord", "hot"))
            for text, rid, ord_, hot in zip(texts(piece.column("text")), *columns):
                for (_, _, part), where in _stretches(text, set(hot), window, prefix).items():
                    words = part.split(b" ")
                    for i in range(len(words) - window + 1):
                        rids.append(rid)
                        ords.append(ord_)
                        digests.append(hashlib.sha256(b" ".join(words[i : i + window])).digest())
                        starts.append([s + i for s in where])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), pa.array(ords, pa.int64()), pa.array(digests, pa.binary()), pa.array(starts, pa.list_(pa.int32()))],
                ["rid", "ord", "digest", "starts"])

    return task


def _remove(batches):
    import pyarrow as pa

    for piece in slices(batches):
        removed, digests, kept = [], [], []
        for text, spans in zip(texts(piece.column("text")), piece.column("spans").to_pylist()):
            words = text.split()
            edge = np.zeros(len(words) + 1, np.int64)
            for span in spans:
                edge[span["start"]] += 1
                edge[span["end"]] -= 1
            stay = (np.cumsum(edge)[: len(words)] == 0).tolist()
            rest = b" ".join(w for w, k in zip(words, stay) if k)
            removed.append(len(words) - sum(stay))
            digests.append(hashlib.sha256(rest).digest())
            kept.append(rest.decode())
        yield pa.RecordBatch.from_arrays(
            [piece.column("rid"), pa.array(removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.string())],
            ["rid", "removed", "kept_sha", "kept_text"])


def _found(df: DataFrame, id_col: str, text_col: str, window: int, prefix: int, hot: int):
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col).withColumn("rid", F.xxhash64("doc_id", "text"))
    if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        rank = F.col("doc_id").cast("long")
    else:
        ids = docs.select("doc_id", F.lit("").alias("g")).where("doc_id IS NOT NULL").distinct()
        docs = docs.join(numbered(ids, [F.col("doc_id")], pos="rank").drop("g"), "doc_id", "left")
        rank = F.col("rank")
    docs = docs.select("doc_id", "text", "rid", F.coalesce(rank, F.lit(LAST)).alias("ord"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"rid bigint, doc_id {kind}, ord bigint, n_words bigint, sha binary, hashes array<bigint>"
    counted = materialize(docs.mapInArrow(_first_pass(window, prefix), schema))
    firsts = materialize(counted.where(F.col("n_words") >= window).groupBy("sha").agg(F.min("ord").alias("first")))
    rows = materialize(counted.join(firsts, "sha", "left").withColumn("copy", F.coalesce(F.col("ord") > F.col("first"), F.lit(False))))

    each = rows.where("NOT copy").select("rid", "ord", F.explode("hashes").alias("hash"))
    shared = materialize(each.groupBy("hash").agg(F.min("ord").alias("a"), F.max("ord").alias("z"), F.count(F.lit(1)).alias("n"))
                         .where("a < z").select("hash", (F.col("n") > hot).alias("is_hot")))
    wanted = each.select("rid", "hash").join(shared, "hash").groupBy("rid").agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("hash"))).alias("cold"),
        F.collect_set(F.when(F.col("is_hot"), F.col("hash"))).alias("hot"))
    touched = materialize(docs.select("rid", "ord", "text").join(wanted, "rid"))

    parts = touched.where(F.size("cold") > 0).select("rid", "ord", "text", "cold").mapInArrow(
        _emit(window, prefix), "key bigint, rid bigint, ord bigint, at int, part binary, starts array<int>")
    spans = parts.repartition("key").sortWithinPartitions("key").mapInArrow(
        _trees(window, prefix), "rid bigint, start int, end int")
    wide = materialize(touched.where(F.size("hot") > 0).select("rid", "ord", "text", "hot").mapInArrow(
        _whole_windows(window, prefix), "rid bigint, ord bigint, digest binary, starts array<int>"))
    least = materialize(wide.groupBy("digest").agg(F.min("ord").alias("first")))
    late = wide.join(least, "digest").where("ord > first").select("rid", F.explode("starts").alias("start"))
    spans = spans.unionByName(late.select("rid", "start", (F.col("start") + window).alias("end")))
    spans = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = touched.select("rid", "text").join(spans, "rid").mapInArrow(
        _remove, "rid bigint, removed bigint, kept_sha binary, kept_text string")
    return docs, rows, cut


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    prefix: int = PREFIX, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row."""
    _, rows, cut = _found(df, id_col, text_col, window, prefix, hot)
    cut = cut.groupBy("rid").agg(F.max("removed").alias("removed"), F.max("kept_sha").alias("kept_sha"))
    empty = F.unhex(F.sha2(F.lit(""), 256))
    kept = F.when(F.col("copy"), empty).otherwise(F.coalesce("kept_sha", "sha"))
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0)))
    return rows.drop("hashes").join(cut, "rid", "left").select(
        "doc_id", "n_words", removed.cast("long").alias("n_removed"), F.lower(F.hex(kept)).alias("kept_sha256"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    prefix: int = PREFIX, hot: int = HOT) -> DataFrame:
    """doc_id, kept_text: the words that stay, joined by single blanks; null text stays null."""
    docs, rows, cut = _found(df, id_col, text_col, window, prefix, hot)
    copies = rows.where("copy").select("rid", F.lit("").alias("kept_text")).distinct()
    new = materialize(cut.select("rid", "kept_text").dropDuplicates(["rid"]).unionByName(copies))
    words = F.trim(F.regexp_replace("text", f"{SPACE_CLASS}+", " "))
    return docs.join(new, "rid", "left").select("doc_id", F.coalesce("kept_text", words).alias("kept_text"))
