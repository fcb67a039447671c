import hashlib
import random
import re

import pytest

from sparkprep.llm import substrings

SCHEMA = "doc_id bigint, text string"


def plain(rows, window):
    """(doc_id, n_words, n_removed, kept_sha256) by comparing all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    order = lambda d: float("inf") if d is None else d
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, float("inf")), order(d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < order(d):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed, window):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["É", "a.b", "ß"]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randint(window - 3, window * 3))] for _ in range(8)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rnd.randint(0, 5)):
            r = rnd.random()
            if r < 0.45:
                p = rnd.choice(passages)
                a = rnd.randint(0, len(p) // 2)
                w += p[a:a + rnd.randint(window // 2, len(p))]
            elif r < 0.6:
                w += [rnd.choice(vocabulary)] * rnd.randint(1, window * 2)
            else:
                w += [rnd.choice(vocabulary) for _ in range(rnd.randint(1, window))]
        rows.append((i * 7 % 61, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (3, rows[5][1]), (None, rows[7][1]), (None, rows[7][1]), (102, None), (103, ""),
             (103, ""), (104, "x " * (window - 1)), (105, "x " * window), (106, "x " * (window * 3))]
    return rows


def key(t):
    return (t[0] is None, t[0] or 0, *t[1:])


@pytest.mark.parametrize("seed,window,prefix,hot", [(1, 50, 8, 50_000), (2, 12, 3, 50_000), (3, 12, 3, 2), (4, 6, 5, 0)])
def test_against_all_windows(spark, seed, window, prefix, hot):
    rows = corpus(seed, window)
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in substrings.substring_dedup(df, window=window, prefix=prefix, hot=hot).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, window), key=key)


def test_kept_texts_and_empty_table(spark):
    rows = corpus(5, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {(r.doc_id, hashlib.sha256((r.kept_text or "").encode()).hexdigest()) for r in
            substrings.without_repeats(df, window=12, prefix=3).collect()}
    assert kept == {(d, h) for d, _, _, h in plain(rows, 12)}
    assert substrings.substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_trees_of_many_rows_at_a_time(spark, monkeypatch):
    """Blocks of a few rows: subtrees stay whole across Arrow batches."""
    rows = corpus(6, 12)
    got = sorted((tuple(r) for r in substrings.substring_dedup(spark.createDataFrame(rows, SCHEMA), window=12, prefix=3).collect()), key=key)
    task = substrings._trees
    monkeypatch.setattr(substrings, "_trees", lambda w, p: task(w, p, 3))
    monkeypatch.setitem(substrings.__dict__, "ROWS", 3)
    again = sorted((tuple(r) for r in substrings.substring_dedup(spark.createDataFrame(rows, SCHEMA), window=12, prefix=3).collect()), key=key)
    assert got == again == sorted(plain(rows, 12), key=key)


def test_text_ids_and_clashing_columns(spark):
    """Ids that are texts are ranked as texts; further columns don't matter."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [("doc-b", f"start {passage} end"), ("doc-a", f"{passage} tail"), ("doc-c", "short"), ("doc-a", passage), (None, passage), ("Z", f"other {passage}")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id string, text string, TEXT string, ord int")
    got = sorted((r.n_removed, r.doc_id or "") for r in substrings.substring_dedup(df).collect())
    assert got == sorted([(60, "doc-b"), (60, "doc-a"), (0, "doc-c"), (60, "doc-a"), (60, ""), (0, "Z")])
