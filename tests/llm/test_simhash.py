import random
import re

import numpy as np
import pytest
import xxhash

from sparkprep.llm import simhash
from sparkprep.llm.components import components

SCHEMA = "doc_id bigint, text string"


def plain_fingerprint(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits):
    """fps: {doc_id: fingerprint}; union by comparing all pairs."""
    label = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= bits and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return label


def corpus():
    rnd = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)] + ["É", "ß", "A,b"]
    out = []
    for k in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 300))]
        out.append(" ".join(base))
        for _ in range(rnd.randint(0, 5)):
            near = list(base)
            near[rnd.randrange(len(near))] = "changed"
            out.append("\n".join(near).upper() if rnd.random() < 0.3 else " ".join(near))
    return out + ["", None, " \t\n", "one", "one two", "one two three four", "x" * 5000, "same " * 3000, out[0], out[0]]


def test_against_all_pairs(spark):
    texts = corpus()
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (int(r.fp) & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df, 4, 4).collect()}
    want = {i * 3: plain_fingerprint(t, 4) for i, t in enumerate(texts)}
    assert {d: f for d, (f, _) in got.items()} == want
    assert {d: c for d, (_, c) in got.items()} == plain_components(want, 4)


@pytest.mark.parametrize("block,pieces,bits", [(3, 2, 4), (8192, 2, 4), (8192, 1, 4), (40, 1, 3), (8192, 2, 7), (8192, 2, 0)])
def test_ball_of_fingerprints(spark, block, pieces, bits):
    """A dense ball of fingerprints; small blocks force the block-pair path."""
    rnd = random.Random(1)
    fps = set()
    for centre in (0, 2**63, rnd.getrandbits(64)):
        for _ in range(120):
            x = centre
            for _ in range(rnd.randint(0, 6)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = {i: x for i, x in enumerate(sorted(fps))}
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps.values()], "fp bigint")
    links = simhash.link_fingerprints(df, bits, block, pieces)
    back = {int(np.uint64(x).astype(np.int64)): i for i, x in fps.items()}
    label = {i: i for i in fps}
    pairs = [(back[r.a], back[r.b]) for r in links.collect()]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    assert label == plain_components(fps, bits)


def test_long_chain_of_links(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)], "a bigint, b bigint")
    got = components(df).collect()
    roots = {}
    for r in got:
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [200, 301]


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (None, "zz")], SCHEMA)
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 2), (2, 2), (2, 2)]
    assert sorted((r.doc_id or -1) for r in simhash.drop_near_copies(df).collect()) == [-1, 2]


def test_kept_rows_carry_all_columns(spark):
    df = spark.createDataFrame([(3, "a b c d e f", "x", 1), (1, "a b c d e f", "y", 2), (7, "other words here now ok", None, 3)],
                               "doc_id bigint, text string, fp string, component_id int")
    assert sorted(map(tuple, simhash.drop_near_copies(df).collect())) == [
        (1, "a b c d e f", "y", 2), (7, "other words here now ok", None, 3)]
