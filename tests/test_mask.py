"""Masking: stable across runs, shared dictionaries, injective, null as 'nan'."""
from pyspark.sql import functions as F

from sparkprep.operators import mask as M
from sparkprep.session import work_path


def test_mask_stable_and_shared(spark):
    refs = work_path(spark, "test-dicts", unique=True)
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", None), (3, "a", "c")], "id int, x string, y string")
    m1 = {r.id: (r.x, r.y) for r in M.mask_columns(df, refs, {"x": "d", "y": "d"}).collect()}
    m2 = {r.id: (r.x, r.y) for r in M.mask_columns(df, refs, {"x": "d", "y": "d"}).collect()}
    assert m1 == m2
    assert m1[1][0] == m1[3][0]          # same value, same key
    assert m1[1][1] == m1[2][0]          # 'b' in x and y share the key
    keys = {k for pair in m1.values() for k in pair}
    assert len(keys) == 4                # a, b, c, nan
    assert all(len(k) == 32 for k in keys)
    d = M.read_dictionary(spark, refs, "d")
    assert {r.value for r in d.collect()} == {"a", "b", "c", "nan"}


def test_mask_keyed(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    got = [r.x for r in M.mask_keyed(df, ["x"], "s").collect()]
    import hashlib
    assert got == [hashlib.sha256(b"sa").hexdigest(), hashlib.sha256(b"snan").hexdigest()]


def test_mask_interleaved_runs_agree(spark):
    """Two first runs side by side: whoever commits first, the keys are the same."""
    refs = work_path(spark, "test-dicts", unique=True)
    df = spark.range(200).selectExpr("id", "cast(id % 7 as string) as v")
    secret = M.secret_of(spark, refs)
    a = df.select("id", M.key_of(F.col("v"), "d", M.hidden(spark, secret)).alias("v"))      # run A has keys, nothing committed yet
    b = M.mask_columns(df, refs, {"v": "d"})                               # run B begins and commits
    M.extend_dictionaries(df, refs, {"v": "d"}, M.secret_of(spark, refs))  # then A commits
    got = {r.id: r.v for r in a.collect()}
    assert got == {r.id: r.v for r in b.collect()} and len(set(got.values())) == 7
    d = M.read_dictionary(spark, refs, "d")
    assert sorted(r.value for r in d.collect()) == [str(i) for i in range(7)]


def test_mask_is_a_projection(spark):
    refs = work_path(spark, "test-dicts", unique=True)
    df = spark.range(10).selectExpr("id", "cast(id as string) as v", "'x' as w")
    out = M.mask_columns(df, refs, {"v": "d", "w": "e"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert M.secret_of(spark, refs) == M.secret_of(spark, refs)


def test_dictionaries_give_other_keys(spark):
    refs = work_path(spark, "test-dicts", unique=True)
    df = spark.createDataFrame([("a", "a")], "x string, y string")
    r = M.mask_columns(df, refs, {"x": "d", "y": "e"}).first()
    assert r.x != r.y


def test_no_plan_shows_the_secret(spark):
    refs = work_path(spark, "test-dicts", unique=True)
    df = spark.range(10).selectExpr("id", "cast(id as string) as v")
    for out, secret in ((M.mask_columns(df, refs, {"v": "d"}), M.secret_of(spark, refs)), (M.mask_keyed(df, ["v"], "some-salt-1"), "some-salt-1")):
        before = out._jdf.queryExecution().toString()
        assert len({r.v for r in out.collect()}) == 10
        plans = before + out._jdf.queryExecution().toString() + out._jdf.queryExecution().executedPlan().treeString()
        assert len(plans) > 200 and secret not in plans
