"""The Merkle manifest against a plain recursion over the whole table."""
import hashlib
import zlib

import pytest

from sparkprep.llm import merkle as M
from sparkprep.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n, text):
    vals = [None if v is None else str(v) for v in (doc, source, lang, n, text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in vals))


def climb(nodes):
    """The top of a tree, and for each leaf its siblings level by level."""
    proofs, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, owners = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a:a + 3]
            for k in range(len(run)):
                for i in owner[a + k]:
                    proofs[i].append((run[:k], run[k + 1:]))
            ups.append(H(*run))
            owners.append(sum(owner[a:a + 3], []))
        nodes, owner = ups, owners
    return nodes[0], proofs


def plain(rows):
    groups = {}
    for d, t, lang, s, n in rows:
        hit = d is not None and zlib.crc32(str(d).encode()) % 2 == 0
        groups.setdefault(s, []).append((d, leaf(d, s, lang, n, t), leaf(d, s, lang, n, t.replace("\n", "") if hit and t is not None else t)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        tops[s] = climb([r[1] for r in groups[s]])
    root, last = climb([tops[s][0] for s in order]) if order else ("", [])
    out = []
    for s, above in zip(order, last):
        sub, proofs = tops[s]
        for (d, own, changed), proof in zip(groups[s], proofs):
            way, node = proof + above, changed
            for left, right in way:
                node = H(*left, node, *right)
            out.append((d, own, sub, root, H(*("".join(a + b) for a, b in way)), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


def some(n, sources):
    return [(i, f"line {i}\nnext {i % 3}" if i % 4 else f"one line {i}", "en", sources[i % len(sources)], i * 2) for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 10, 28, 400])
def test_sizes(spark, n):
    rows = some(n, ["a", "b", None, "é", "B"][:1 + n % 5])
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(M.manifest(df, M.without_line_feeds("doc_id", "text"))) == plain(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_small_blocks_make_many_levels(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    rows = some(300, ["hot"] * 8 + [f"s{i}" for i in range(30)])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(M.manifest(df, M.without_line_feeds("doc_id", "text"))) == plain(rows)


def test_edges(spark):
    rows = some(50, ["a", None]) + [(None, "x\n", None, None, None), (None, None, None, None, None), (7, None, "en", "a", 1), (7, "", "en", "a", 1),
                                    (9, "same\n", "", "", 0), (9, "same\n", "", "", 0), (-5, "é\n" * 90_000, "fr", "a", None)]
    rows += [(500, "copy\nof one", "en", "hot", 11)] * 200
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", TEXT string, g int")
    assert got(M.manifest(wide, None).select("*")) == sorted(
        [(a, b, c, d, e, d, True) for a, b, c, d, e, _, _ in plain(rows)], key=str)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(M.manifest(df, M.without_line_feeds("doc_id", "text"))) == plain(rows)
    assert M.manifest(df.limit(0)).collect() == []


def test_versions_share_all_but_ancestors():
    tree = M.Arena([H(str(i)) for i in range(20)], 3)
    nodes = len(tree.digests)
    root = tree.version(13, H("new"))
    assert len(tree.digests) == nodes + 4
    seen, todo = set(), [root]
    while todo:
        n = todo.pop()
        seen.add(n)
        todo += tree.children[n]
    assert len(seen & set(range(nodes))) == len(seen) - 4
    assert tree.digests[root] == climb([H("new") if i == 13 else H(str(i)) for i in range(20)])[0]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    result = got(QUERIES["op13_merkle_manifest"](spark, sf_dir))
    assert result == plain(rows) and {r[6] for r in result} == {True, False}
