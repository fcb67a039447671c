"""Operator 7, SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; a bit is 1 if more than half of the text's shingle
hashes have it. Two fingerprints link if they differ in ``bits`` bits or less.

Search. Of two halves of 32 bits, one differs in ``bits // 2`` bits or less.
For each half every distinct fingerprint emits all variants of the half within
half of that radius: two halves that are close meet in a variant between them.
The variants are shuffled, and fingerprints that meet are compared in all 64
bits. With 4 bits a fingerprint emits 66 short rows. Balls around the whole
fingerprint (``pieces=1``) take 2,081 rows, some 30 KB for a document.

Fingerprints that share a variant are never paired row by row: a run is
searched breadth first, each found member compared at once with those not yet
found, and a member is written once, with its run's root. A run of more than
``BLOCK`` members is cut into blocks; each pair of blocks is then a group of its
own, in another task, so that long runs are searched whole too.

Defined results: null counts as empty; texts without words have fingerprint
zero and link like others; rows that repeat an id are documents of their own;
a null id never names a component unless all its ids are null; a text of any
length is one fingerprint, taken in one task; an empty table gives no rows;
further columns are not looked at, but ``drop_near_copies`` carries them."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, exact, slices, texts
from .components import components

SEED = 42
BLOCK = 8192
#: Runs up to this are compared pair by pair, all runs of a batch at once.
SMALL = 8
HALF = 32
#: Pieces of a fingerprint whose variants are shuffled: 2 halves, or 1 for the whole.
PIECES = 2


def fingerprint(text: bytes, words: int, seed: int = SEED, chunk: int = 1 << 15) -> bytes:
    """The fingerprint, most significant byte first."""
    tokens = text.lower().split()  # both ASCII only, as bytes
    n = max(1, len(tokens) - words + 1)
    joined = b" ".join(tokens)
    if not tokens:
        return bytes(8)
    if n == 1:
        begin, end = [0], [len(joined)]
    else:
        size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
        last = np.cumsum(size)
        begin, end = (last - size)[:n].tolist(), (last - 1)[words - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, chunk):
        shingles = map(joined.__getitem__, map(slice, begin[i : i + chunk], end[i : i + chunk]))
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(0, np.int32)
    return np.packbits(ones * 2 > n).tobytes()


def fingerprints(df: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed number) for each row."""
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            fps = np.frombuffer(b"".join(fingerprint(t, words) for t in texts(piece.column("text"))), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(fps)], ["doc_id", "text_hash", "fp"])

    return docs.mapInArrow(task, f"doc_id {kind}, text_hash bigint, fp bigint")


def variants(fps: DataFrame, bits: int, pieces: int = PIECES) -> DataFrame:
    """(key, fp): for each piece of the fingerprint (two halves, or one whole)
    every variant within half the radius that a close pair keeps in some piece."""
    width, radius = 64 // pieces, (bits // pieces + 1) // 2
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    flips = F.array(*[F.lit(signed(m)).cast("long") for m in masks])
    around = lambda value: F.transform(flips, lambda m: value.bitwiseXOR(m))
    if pieces == 1:
        return fps.select(F.explode(around(F.col("fp"))).alias("key"), "fp")
    low, high = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)), F.shiftrightunsigned("fp", HALF)
    # A bit above the half tells the halves apart.
    keys = F.concat(around(low), around(high.bitwiseOR(F.lit(1 << HALF))))
    return fps.select(F.explode(keys).alias("key"), "fp")


def _linked(run: np.ndarray, bits: int):
    """(root, member) arrays that connect what links connect in ``run``."""
    roots, members = [], []
    rest = run
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                roots.append(np.full(len(found), root))
                members.append(found)
    none = np.empty(0, np.uint64)
    return (np.concatenate(roots), np.concatenate(members)) if roots else (none, none)


def _meet(bits: int, block: int):
    """Streams rows sorted by key; gives links, and the members of long runs."""

    def out(a, b, key, part):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(key, pa.int64()), pa.array(part, pa.int32())],
            ["a", "b", "key", "part"])

    def links(keys, fps):
        """All runs of these rows, whole."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[starts, len(keys)])
        a, b = [], []
        left = np.repeat(size, size) - (np.arange(len(keys)) - np.repeat(starts, size))  # members from here on
        small = np.repeat((size > 1) & (size <= SMALL), size)
        for k in range(1, SMALL):
            i = np.flatnonzero(small & (left > k))
            if not len(i):
                break
            i = i[np.bitwise_count(fps[i] ^ fps[i + k]) <= bits]
            a.append(fps[i])
            b.append(fps[i + k])
        for s in np.flatnonzero(size > SMALL):
            x, y = _linked(fps[starts[s] : starts[s] + size[s]], bits)
            a.append(x)
            b.append(y)
        x, y = np.concatenate(a or [fps[:0]]), np.concatenate(b or [fps[:0]])
        return out(x, y, np.zeros(len(x), np.int64), np.full(len(x), -1, np.int32))

    def task(batches):
        keys, fps, parts = np.empty(0, np.int64), np.empty(0, np.uint64), 0
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            while len(keys):
                last = int(np.searchsorted(keys, keys[-1]))  # the last run may go on in the next batch
                if parts and last:
                    # the end of a long run
                    n = int(np.searchsorted(keys, keys[0], "right"))
                    yield from part(keys[:n], fps[:n], parts)
                    keys, fps, parts = keys[n:], fps[n:], 0
                elif last:
                    yield links(keys[:last], fps[:last])
                    keys, fps = keys[last:], fps[last:]
                elif len(keys) > block:
                    yield from part(keys[:block], fps[:block], parts)
                    keys, fps, parts = keys[block:], fps[block:], parts + 1
                else:
                    break
        if parts:
            yield from part(keys, fps, parts)
        elif len(keys):
            yield links(keys, fps)

    def part(keys, fps, number):
        yield links(keys, fps)
        yield out(fps, fps, keys, np.full(len(fps), number, np.int32))

    return task


def link_fingerprints(fps: DataFrame, bits: int, block: int = BLOCK, pieces: int = PIECES) -> DataFrame:
    """(a, b): links that connect just the fingerprints of one component.
    ``fps`` has distinct values of fp."""
    met = variants(fps, bits, pieces).repartition("key").sortWithinPartitions("key", "fp")
    met = materialize(met.mapInArrow(_meet(bits, block), "a bigint, b bigint, key bigint, part int"))
    links = met.where("part < 0").select("a", "b")
    # Members of long runs: every pair of blocks becomes a group.
    members = met.where("part >= 0").select("key", F.col("a").alias("fp"), "part")
    lengths = members.groupBy("key").agg(F.max("part").alias("last"))
    other = members.join(lengths, "key").where("last > 0").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("last")))).where("other <> part")
    pairs = other.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "fp")

    def both(table):
        import pyarrow as pa

        x, y = _linked(table.column("fp").to_numpy().view(np.uint64), bits)
        return pa.table({"a": x.view(np.int64), "b": y.view(np.int64)})

    return links.unionByName(pairs.groupBy("key", "lo", "hi").applyInArrow(both, "a bigint, b bigint"))


def near_duplicates(df: DataFrame, words: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text",
                    pieces: int = PIECES) -> DataFrame:
    """doc_id, text_hash, fp, component_id for each row."""
    if not 0 <= bits < HALF:
        raise ValueError("bits must be from 0 to 31")
    docs = materialize(fingerprints(df, words, id_col, text_col))
    nodes = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = materialize(components(link_fingerprints(nodes.select("fp"), bits, pieces=pieces)))
    named = roots.join(nodes, roots["node"] == nodes["fp"])
    # Written, so that Spark can split a hot component's side of the join.
    names = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    of_node = roots.join(names, "root").select(F.col("node").alias("fp"), "component_id")
    labels = materialize(nodes.join(of_node, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")))
    return docs.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(df: DataFrame, words: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id, with all its
    columns; of rows with that id the smallest text hash, then any equal row."""
    cols = df.columns
    found = near_duplicates(df, words, bits, id_col, text_col)
    # Fingerprints of a component without ids still tell its rows apart.
    group = F.coalesce(F.concat(F.lit("i"), F.col("component_id").cast("string")), F.concat(F.lit("f"), F.col("fp").cast("string")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("text_hash").alias("hash"))
    keep = found.groupBy(group.alias("group")).agg(F.min(first).alias("first"))
    keep = keep.select(F.col("first.doc_id").alias("k_id"), F.col("first.hash").alias("k_hash")).distinct()
    flat = df.toDF(*[f"c{k}" for k in range(len(cols))])
    rows = flat.withColumns({"k_hash": F.xxhash64(f"c{cols.index(text_col)}"), "r_id": F.col(f"c{cols.index(id_col)}")})
    kept = rows.join(keep.withColumnRenamed("k_hash", "w_hash"),
                     (F.col("k_hash") == F.col("w_hash")) & F.col("r_id").eqNullSafe(F.col("k_id")), "left_semi")
    # Equal rows, combined before the shuffle: one of them.
    one = kept.groupBy("k_hash", "r_id").agg(F.max(F.struct(*flat.columns)).alias("row"))
    return one.select(*[f"row.{c}" for c in flat.columns]).toDF(*cols)
