import hashlib

from pyspark.sql import functions as F

from sparkprep.llm import exact_dedup as X

SCHEMA = "doc_id bigint, text string"


def plain(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out, kept = [], set()
    for d, t in rows:
        ids = groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        first = (best, t or "") not in kept and d == best
        if first:
            kept.add((best, t or ""))
        out.append((d, best, len(ids), first, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def key(t):
    return (t[0] is None, t[0] or 0, t[4], t[3])


ROWS = [(i, f"text {i % 17}") for i in range(200)] + [(300 + i, "hot") for i in range(500)] + [
    (1000, None), (1001, ""), (1002, " "), (None, "text 3"), (None, "only null"), (None, "only null"), (7, "text 7"), (7, "text 7"),
    (1003, "x" * 200_000), (1004, "x" * 200_000), (1005, "é"), (1006, "é"), (1007, "A"), (1008, "a"), (-5, "neg"), (-9, "neg")]


def test_against_groups(spark):
    got = [tuple(r) for r in X.exact_dedup(spark.createDataFrame(ROWS, SCHEMA)).collect()]
    assert sorted(got, key=key) == sorted(plain(ROWS), key=key)


def test_one_salt_gives_the_same(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(tuple, X.exact_dedup(df, salts=1).collect()), key=key) == sorted(map(tuple, X.exact_dedup(df, salts=64).collect()), key=key)


def test_rows_that_stay_have_their_columns(spark):
    df = spark.createDataFrame([(1, "a", "x", 5), (4, "a", None, 6), (4, "a", "z", 7), (2, None, "q", 1), (3, "", "r", 2), (None, "n", "s", 0)],
                               "doc_id bigint, text string, Text string, digest int")
    assert sorted((tuple(r) for r in X.drop_exact_copies(df).collect()), key=str) == sorted(
        [(4, "a", "z", 7), (3, "", "r", 2), (None, "n", "s", 0)], key=str)


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "b", 2, 3)], "doc_id bigint, text string, TEXT string, salt int, keep_id int")
    assert [r.keep_id for r in X.exact_dedup(df).collect()] == [1]
    empty = spark.createDataFrame([], SCHEMA)
    assert X.exact_dedup(empty).collect() == [] and X.drop_exact_copies(empty).collect() == []


def test_no_python_and_local_combining(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for out in (X.exact_dedup(df), X.drop_exact_copies(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "partial_max" in plan


def test_whole_table_against_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = X.exact_dedup(docs)
    want = docs.groupBy(F.coalesce("text", F.lit("")).alias("t")).agg(F.max("doc_id").alias("k"), F.count("*").alias("n"))
    assert sorted((r.keep_id, r.group_size) for r in got.where("kept").collect()) == sorted((r.k, r.n) for r in want.collect())
    assert sorted(r.doc_id for r in X.drop_exact_copies(docs).collect()) == sorted(r.k for r in want.collect())


def test_a_task_sends_one_row_for_a_text(spark):
    """Copies with different ids, in three tasks: three rows leave the tasks."""
    docs = X._hashed(spark.range(0, 6000, 1, 3).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text")), 16)
    salted = X._local(docs, 16, F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    assert sorted(r.n for r in salted.collect()) == [2000] * 3
