import random
from fractions import Fraction

import pytest

from sparkprep.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string"


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target} with exact fractions, source by source."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - cap * sum(sizes[s] for s in full)
        unit = sum(weight[s] for s in sizes if s not in full)
        target = {s: Fraction(cap * sizes[s]) if s in full else Fraction(left * weight[s], unit) for s in sizes}
        new = {s for s in sizes if s not in full and target[s] > cap * sizes[s]}
        if not new:
            return {s: float(t) for s, t in target.items()}
        full |= new


def documents(seed=1, n=600):
    rnd = random.Random(seed)
    names = ["b", "a", "ä", "Z", "\U0001F600", "￿", None, ""]
    rows = []
    for i in range(n):
        s = "b" if i % 3 == 0 else rnd.choice(names)
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(["w"] * rnd.choice([1, 5, 40, 300])), s))
    return rows + [(n, None, "a"), (n + 1, "", "only empty"), (None, "two words", "a"), (3, "x y z", "a"), (3, "x y z", "a")]


def test_targets_and_copies(spark):
    rows = documents()
    got = M.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        assert r.taken == r.size * r.n_copies and r.taken <= 3 * r.size
        by_source.setdefault((r.source_size, r.target), []).append(r)
    assert all(any(a == sizes[s] and abs(b - want[s]) < 1e-6 for a, b in by_source) for s in sizes)
    assert all(any(a == sizes[s] and abs(b - want[s]) < 1e-6 for s in sizes) for a, b in by_source)
    for (size, target), group in by_source.items():
        if size:
            rate = target / size
            assert {r.n_copies for r in group} <= {int(rate), int(rate) + 1}
            assert abs(sum(r.taken for r in group) - target) <= 2 * 300 + 0.02 * target


def test_reruns_agree_in_any_order(spark):
    rows = documents(2)
    one = M.mix_plan(spark.createDataFrame(rows, SCHEMA))
    random.Random(1).shuffle(rows)
    two = M.mix_plan(spark.createDataFrame(rows, SCHEMA).repartition(7))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, one.collect()), key=key) == sorted(map(tuple, two.collect()), key=key)


def test_mixed_rows_follow_the_plan(spark):
    rows = documents(3)
    df = spark.createDataFrame(rows, SCHEMA)
    plan, out = {}, {}
    for r in M.mix_plan(df).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.n_copies
    mixed = M.mix(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        out[r.doc_id] = out.get(r.doc_id, 0) + 1
    assert out == {d: n for d, n in plan.items() if n}


def test_every_whole_number_is_passed_once(spark):
    """One size, so that the walk is by id: copies are differences of one running sum."""
    rows = [(i, "a b c", "s%d" % (i % 2)) for i in range(1000)]
    got = M.mix_plan(spark.createDataFrame(rows, SCHEMA), parts=5)
    for name in {r.target for r in got.collect()}:
        group = [r for r in got.collect() if r.target == name]
        assert abs(sum(r.n_copies for r in group) - name / 3) < 1


def test_targets_near_on_the_real_table(spark, sf_dir):
    got = M.mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    by = got.groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect()
    for r in by:
        assert abs(r["sum(taken)"] - r["target"]) <= r["max(size)"]


def test_many_sources_and_empty_table(spark):
    rows = [(i, "w " * (1 + i % 7), f"{chr(97 + i % 26)}{i:05d}") for i in range(400)]
    got = M.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    want = plain_targets({s: len(t.split()) for _, t, s in rows})
    for r in got:
        assert r.target == pytest.approx(want[rows[r.doc_id][2]])
    assert M.mix_plan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert M.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    none = M.mix_plan(spark.createDataFrame([(1, None, "a"), (2, "", None)], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in none] == [(0, 0, 0.0, 0)] * 2


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", "s", 9, 8, 7)], "doc_id bigint, text string, source string, size int, Text int, n_copies int")
    assert [r.taken for r in M.mix_plan(df).collect()] == [2]
    assert [tuple(r) for r in M.mix(df).collect()] == [(1, "a b", "s", 9, 8, 7)]


def test_texts_are_not_sorted(spark):
    """No window, sort or sort-merge join of ``mix`` has the texts in it."""
    import re

    plan = M.mix(spark.createDataFrame(documents(4), SCHEMA))._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
    # c1 is the text: where rows are sorted or numbered it is not among the columns.
    lines = plan.splitlines()
    at = [i for i, line in enumerate(lines) if re.search(r"\b(Window|Sort)\b", line)]
    below = [line for i in at for line in lines[i + 1 :] if len(re.match(r"[ :|+-]*", line)[0]) > len(re.match(r"[ :|+-]*", lines[i])[0])]
    assert at and not any(re.search(r"\bc1#", line) for line in below)
