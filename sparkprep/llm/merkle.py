"""A Merkle manifest of a dataset, and what a changed document does to it
(operator 13).

Every row is a leaf. The leaves of a source, ascending by doc_id, are joined in
threes level by level to the source's subroot; the subroots, ordered by source,
likewise to the root. ``manifest`` gives each row its leaf, subroot, root,
digest of its proof (the siblings on the way to the root), and the root that
its (perhaps changed) text leads to.

The tree is persistent. An aligned block of 3**6 leaves is built in one task as
an arena of nodes; each document makes a version of it that shares all nodes but
the ancestors of its own leaf, which are copied. Versions go on above the
blocks: the block roots are the leaves of the next blocks, and the way from a
block root to the root is found once and joined to the block's versions, which
fold along it by themselves. So no task holds more than a block, whatever the
size of a source or the number of sources, and a hot source is many blocks.

Results for the cases at the edge: null values are ``-`` in a leaf; null and
empty texts differ; null ids come first in their source; rows of one id are
ordered by leaf, so repeated rows each have a leaf; a source of one document has
its leaf as subroot, a single subroot is the root; a proof without siblings is the
digest of the empty string; texts of any length are digested by Spark's own
functions; an empty table gives no rows; further columns are not looked at."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import exact
from .ordered import group_key, numbered

FANOUT = 3
#: Levels of a block: 729 leaves.
LEVELS = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (hex) of the values, each ``-`` if null, else byte count, ``:``, value."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def without_line_feeds(id_col: str, text_col: str) -> Column:
    """The text less its line feeds where 2 divides the id's CRC-32; a null id changes nothing."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.translate(text_col, "\n", "")).otherwise(F.col(text_col))


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Arena:
    """The nodes of one block and of its versions. A node is a digest and the
    numbers of its children; nodes are added and never changed. ``levels`` has
    the nodes of the first version from the leaves up."""

    def __init__(self, leaves: list[str], levels: int):
        self.digests: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.levels = [[self._add(d, ()) for d in leaves]]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([self._parent(tuple(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])
        self.root = self.levels[-1][0]

    def _add(self, digest: str, children: tuple[int, ...]) -> int:
        self.digests.append(digest)
        self.children.append(children)
        return len(self.digests) - 1

    def _parent(self, children: tuple[int, ...]) -> int:
        return self._add(_hash([self.digests[c] for c in children]), children)

    def version(self, i: int, digest: str) -> int:
        """The root of a version whose i-th leaf has this digest: the leaf and
        its ancestors are new nodes, all others are those of the first version."""
        node = self._add(digest, ())
        for nodes in self.levels[:-1]:
            low = i - i % FANOUT
            node = self._parent((*nodes[low:i], node, *nodes[i + 1:low + FANOUT]))
            i //= FANOUT
        return node

    def siblings(self, i: int) -> list[tuple[str, str]]:
        """Per level from the leaf up: the digests left and right of the node in its run."""
        out, d = [], self.digests
        for nodes in self.levels[:-1]:
            low = i - i % FANOUT
            out.append(("".join(d[x] for x in nodes[low:i]), "".join(d[x] for x in nodes[i + 1:low + FANOUT])))
            i //= FANOUT
        return out


def _levels(block: int, size: int, most: int) -> int:
    """A block alone in its group ends with one node; others have all levels."""
    if block or size == FANOUT ** most:
        return most
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


_WAY = "way array<struct<left: string, right: string>>"


def _blocks(nodes: DataFrame, values: list[str]) -> DataFrame:
    """g, block and the block's nodes in order: (pos, digest, values)."""
    of = F.sort_array(F.collect_list(F.struct("pos", "digest", *values)))
    return nodes.groupBy("g", F.expr(f"pos div {FANOUT ** LEVELS}").alias("block")).agg(of.alias("nodes"))


def _ways(nodes: DataFrame) -> DataFrame:
    """For nodes (g, pos, digest): the way from each to the root of its block, and that root."""
    most = LEVELS

    def task(batches):
        import pyarrow as pa

        way = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for batch in batches:
            for g, block, members in zip(*(batch.column(c).to_pylist() for c in ("g", "block", "nodes"))):
                tree = Arena([m["digest"] for m in members], _levels(block, len(members), most))
                ways = [[{"left": a, "right": b} for a, b in tree.siblings(i)] for i in range(len(members))]
                n = len(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n), pa.array([m["pos"] for m in members], pa.int64()), pa.array(ways, way),
                     pa.array([block] * n, pa.int64()), pa.array([tree.digests[tree.root]] * n)], ["g", "pos", "way", "block", "top"])

    return _blocks(nodes, []).mapInArrow(task, f"g string, pos bigint, {_WAY}, block bigint, top string")


def _to_top(nodes: DataFrame) -> DataFrame:
    """For nodes (g, pos, digest): g, pos, the whole way to the group's top, and
    the top. One step for each factor of a block in the largest group."""
    ways = materialize(_ways(nodes))
    if (ways.agg(F.max("block")).first()[0] or 0) == 0:
        return ways.drop("block")
    above = _to_top(ways.groupBy("g", F.col("block").alias("pos")).agg(F.first("top").alias("digest")))
    above = above.select("g", F.col("pos").alias("block"), F.col("way").alias("more"), F.col("top").alias("__top"))
    return (ways.join(above, ["g", "block"]).withColumn("way", F.concat("way", "more"))
            .select("g", "pos", "way", F.col("__top").alias("top")))


def _versions(leaves: DataFrame, doc_type: str) -> DataFrame:
    """The first blocks: per document its siblings within the block (one text),
    the block's root, and the root of the version with its changed leaf."""
    most = LEVELS

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("nodes").type.value_type.field("doc_id").type
            for g, block, members in zip(*(batch.column(c).to_pylist() for c in ("g", "block", "nodes"))):
                tree = Arena([m["digest"] for m in members], _levels(block, len(members), most))
                n, proofs, versions = len(members), [], []
                for i, m in enumerate(members):
                    proofs.append("".join(a + b for a, b in tree.siblings(i)))
                    versions.append(tree.digests[tree.version(i, m["changed"])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n), pa.array([block] * n, pa.int64()), pa.array([m["doc_id"] for m in members], ids),
                     pa.array([m["digest"] for m in members]), pa.array([tree.digests[tree.root]] * n), pa.array(proofs), pa.array(versions)],
                    ["g", "block", "doc_id", "leaf", "top", "proof", "version"])

    schema = f"g string, block bigint, doc_id {doc_type}, leaf string, top string, proof string, version string"
    return _blocks(leaves, ["doc_id", "changed"]).mapInArrow(task, schema)


def manifest(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified
    for every row. ``changed_text`` is the text (an expression over the columns
    of ``docs``) whose leaf is folded along the siblings; by default the text."""
    rows = exact(docs, *COLUMNS)
    values = [F.col(c) for c in COLUMNS]
    leaf = leaf_digest(*values)
    changed = leaf if changed_text is None else leaf_digest(*values[:-1], changed_text)
    # The texts are read once; from here on there are digests only.
    leaves = materialize(rows.select("doc_id", group_key(F.col("source")).alias("g"), leaf.alias("digest"), changed.alias("changed")))
    doc_type = leaves.schema["doc_id"].dataType.simpleString()
    placed = numbered(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    versions = materialize(_versions(placed, doc_type))

    # From the roots of the first blocks to the subroots, and on to the root.
    tops = versions.groupBy("g", F.col("block").alias("pos")).agg(F.first("top").alias("digest"))
    blocks = _to_top(tops).withColumnRenamed("top", "subroot")
    subroots = blocks.where("pos = 0").select(F.lit("").alias("all"), "g", F.col("subroot").alias("digest"))
    ranked = numbered(subroots, [F.col("g")], group="all").select(F.col("all").alias("g"), F.col("g").alias("source"), "pos", "digest")
    ranked = materialize(ranked)
    last = _to_top(ranked.drop("source")).select("pos", F.col("way").alias("last"), F.col("top").alias("root"))
    last = ranked.join(last, "pos").select(F.col("source").alias("g"), "last", "root")
    ways = materialize(blocks.join(last, "g").select(
        "g", F.col("pos").alias("block"), "subroot", "root", F.concat("way", "last").alias("way"),
        F.array_join(F.transform(F.concat("way", "last"), lambda s: F.concat(s["left"], s["right"])), "").alias("rest")))
    out = versions.join(ways, ["g", "block"])
    # The distributed upper part of each version: one new node a level.
    folded = F.aggregate("way", F.col("version"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    return out.select(
        "doc_id", F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("source"), "leaf", "subroot", "root",
        F.sha2(F.concat("proof", "rest"), 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
