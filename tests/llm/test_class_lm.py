import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkprep.llm import class_lm as L

SCHEMA = "doc_id bigint, text string"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def rows_of_two_languages(n=400, seed=1):
    """Words of two languages alternate between two kinds, so that classes help."""
    rnd = random.Random(seed)
    kinds = [[f"{a}{i}{e}" for i in range(60)] for a, e in (("n", "en"), ("v", "at"), ("s", "ix"), ("t", "ou"))]
    rows = []
    for i in range(n):
        first, second = kinds[:2] if i % 2 else kinds[2:]
        rows.append((i, " ".join(rnd.choice(first if k % 2 else second) for k in range(rnd.randint(4, 60)))))
    return rows + [(1000, None), (1001, ""), (1002, "Never Seen words"), (1003, "É ß É"), (1003, "É ß É"), (None, "null id")]


@pytest.mark.parametrize("dictionary,words", [(200_000, 1024), (15, 8)])
def test_base_score_against_counting(spark, monkeypatch, dictionary, words):
    monkeypatch.setattr(L, "DICTIONARY", dictionary)
    monkeypatch.setattr(L, "WORDS", words)
    rows = rows_of_two_languages()
    train = [tokens(t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    got = L.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        held = d is None or zlib.crc32(str(d).encode()) % 10 == 0
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        want.setdefault(d, (held, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, base))
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)
    held = [r for r in got if r.held_out and r.n_tokens > 4 and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.9  # better than words alone


def test_exchange_finds_the_kinds():
    """Units of two kinds that alternate end in two classes, whatever the start."""
    rnd = np.random.default_rng(2)
    n = 20
    pairs = np.zeros((n + 1, n + 1))
    for a in range(n):
        for b in range(n):
            if a % 2 != b % 2:
                pairs[a, b] = rnd.integers(5, 40)
    pairs[n, :n] = pairs[:n, n] = 3
    order = rnd.permutation(n)
    pairs[:n, :n] = pairs[np.ix_(order, order)]
    of = L.exchange(pairs, classes=2, sweeps=20)
    assert of[n] == 2
    kinds = order % 2
    assert len({(int(k), int(c)) for k, c in zip(kinds, of[:n])}) == 2


def likelihood(table):
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(table) - f(table.sum(0)) - f(table.sum(1))


def test_exchange_only_improves():
    rnd = np.random.default_rng(3)
    pairs = rnd.integers(0, 9, (41, 41)).astype(float)
    scores = [likelihood(L.class_table(pairs, L.exchange(pairs, 5, s), 6)) for s in range(5)]
    assert all(b >= a - 1e-9 for a, b in zip(scores, scores[1:])) and scores[-1] > scores[0]


def test_empty_tables_and_no_training_texts(spark):
    assert L.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = L.score_texts(spark.createDataFrame([(held, "a b")], SCHEMA)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert r.base_score == pytest.approx(0.0) and math.isfinite(r.score)


def test_clashing_names_and_long_texts(spark):
    df = spark.createDataFrame([(i, "w%d " % (i % 3) * 20_000, "x", 1.0) for i in range(6)],
                               "doc_id bigint, text string, Text string, score double")
    assert {r.n_tokens for r in L.score_texts(df).collect()} == {20_001}


def plain_tables(rows, class_of, end):
    """How often classes follow each other, and the classes around each word."""
    follow, before, after = Counter(), Counter(), Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 10 == 0:
            continue
        words = tokens(t)[:-1]
        line = [end] + [class_of(w) for w in words] + [end]
        follow.update(zip(line, line[1:]))
        for i, w in enumerate(words):
            before[w, line[i]] += 1
            after[w, line[i + 2]] += 1
    return follow, before, after


def as_docs(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(0)) == 0)


def test_sweep_against_counting(spark, monkeypatch):
    """Tables of one pass, and each word's class by the definition of its gain."""
    rows = rows_of_two_languages(150)
    docs = as_docs(spark, rows).repartition(3)
    every = sorted({w for _, t in rows for w in tokens(t) if w is not None})
    words = [w.encode() for w in every[::2]]
    rnd = random.Random(4)
    class_of = np.array([rnd.randrange(5) for _ in words], np.int64)
    of_ending = np.array([rnd.randrange(5) for _ in range(L.ENDINGS)], np.int64)
    at = dict(zip(words, class_of.tolist()))
    cls = lambda w: at.get(w.encode(), int(of_ending[L.ending(w.encode())]))
    follow, before, after = plain_tables(rows, cls, 5)
    table = L.class_pairs(L.count_neighbours(docs, words, class_of, of_ending, 5, False), 5)
    assert {(i, j): table[i, j] for i in range(6) for j in range(6) if table[i, j]} == follow
    monkeypatch.setattr(L, "BLOCK", 7)
    found = L.count_neighbours(docs, words, class_of, of_ending, 5, True)
    assert (L.class_pairs(found, 5) == table).all()
    moved = L.moved_words(found, class_of, table)
    for w, got, old in zip(words, moved.tolist(), class_of.tolist()):
        w = w.decode()
        n = sum(before[w, k] for k in range(6))
        gain = [sum(before[w, k] * math.log(table[k, c] + 0.5) + after[w, k] * math.log(table[c, k] + 0.5) for k in range(6))
                - n * (math.log(table[c].sum() + 0.5) + math.log(table[:, c].sum() + 0.5)) for c in range(5)]
        assert got == old if not n else gain[got] == pytest.approx(max(gain))


def test_score_by_its_definition(spark):
    rows = rows_of_two_languages(300)
    docs, df = as_docs(spark, rows), spark.createDataFrame(rows, SCHEMA)
    counts = L.count_words(docs)
    c = {r.word.decode(): r.c for r in counts.collect()}
    n_train = sum(c.values())
    words, n, word_class, ending_class, follow = L.fit_classes(docs, counts.where("length(word) > 0"), n_train)
    end = len(follow) - 1
    at = {w.decode(): int(k) for w, k in zip(words, word_class)}
    cls = lambda w: end if w is None else at.get(w, int(ending_class[L.ending(w.encode())]))
    table, _, _ = plain_tables(rows, cls, end)
    assert {(i, j): follow[i, j] for i in range(end + 1) for j in range(end + 1) if follow[i, j]} == table
    into = follow.sum(0)
    members = Counter(cls(w or None) for w in c)
    share = (into + 1) / (into.sum() + end + 1)
    for r in L.score_texts(df).collect():
        texts = {t for d, t in rows if d == r.doc_id}
        want = []
        for t in texts:
            last, total = end, 0.0
            for w in tokens(t):
                k = cls(w)
                total += math.log10((follow[last, k] + L.BETA * share[k]) / (follow[last].sum() + L.BETA))
                total += math.log10((c.get("" if w is None else w, 0) + L.ALPHA) / (into[k] + L.ALPHA * (members[k] + 1)))
                last = k
            want.append(total)
        assert any(r.score == pytest.approx(x, rel=1e-9) for x in want)


def test_words_of_one_size_are_cut_by_word(spark):
    """More words that occur once than fit: the dictionary is filled with some of them."""
    from pyspark.sql import functions as F

    counts = spark.range(5000).select(F.encode(F.concat(F.lit("w"), "id"), "utf-8").alias("word"), F.when(F.col("id") < 10, 9).otherwise(1).cast("long").alias("c"))
    words, n = L.frequent_words(counts, 1000)
    assert 900 <= len(words) <= 1000 and (n[:10] == 9).all() and len(set(words)) == len(words)
    assert L.frequent_words(counts, 1000)[0] == words


def test_word_sweeps_raise_the_likelihood(spark):
    rows = rows_of_two_languages(400)
    docs = as_docs(spark, rows)
    counts = L.count_words(docs).where("length(word) > 0")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(L, "WORDS", 4)  # endings alone can't tell the kinds apart
        m.setattr(L, "ENDINGS", 128)
        found = []
        for sweeps in (0, 1, 2):
            m.setattr(L, "WORD_SWEEPS", sweeps)
            found.append(L.likelihood(L.fit_classes(docs, counts, 10_000)[4]))
    assert found[0] <= found[1] <= found[2]


def test_texts_of_a_batch_are_one_line():
    """End tokens stand around every text, empty ones too."""
    assert L._line([2, 0, 1, 0], np.array([5, 6, 7]), 9).tolist() == [9, 5, 6, 9, 9, 7, 9, 9]
    assert L._line([], np.array([], np.int64), 9).tolist() == [9]


def test_sweeps_read_codes(spark, monkeypatch):
    """Training texts are split into words twice: to be counted and to be encoded."""
    docs = spark.createDataFrame([("A b b c", False), (None, False), ("zz b", False), ("b q", True)], "text string, held_out boolean")
    words = [b"b", b"a"]
    coded = L.encode_texts(docs, words)
    got = sorted(np.frombuffer(r.codes, "<i4").tolist() for r in coded.collect())
    assert got == sorted([[1, 0, 0, 2 + L.ending(b"c")], [], [2 + L.ending(b"zz"), 0]])
    pairs = L.count_unit_pairs(coded, words, 1)  # the second word goes by its ending
    assert pairs.sum() == 4 + 2 + 3 and pairs[0, 0] == 1 and pairs[-1, -1] == 1 and pairs[-1, 1 + L.ending(b"a")] == 1
    assert not any("text" in part.columns for part in (coded, L.count_neighbours(coded, words, np.array([0, 1]), np.zeros(L.ENDINGS, np.int64), 2, True)))
