"""Skew: one key holding a third of the rows. Results stay exact when AQE
splits the hot partition, and first-seen aggregates combine map-side."""
from pyspark.sql import functions as F

from sparkprep.functions import contacts as C
from sparkprep.operators import lines as L
from sparkprep.operators import relational as R

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_universe_join(spark):
    n = 30000
    main = spark.range(n).select(F.col("id").alias("oid"),
                                 F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"))
    uni = spark.range(1000).select(F.col("id").alias("uk"), (F.col("id") * 2).alias("w"))
    main.createOrReplaceTempView("sp_skew_main")
    uni.createOrReplaceTempView("sp_skew_uni")

    def run():
        df = R.restrict_to_universe(main, uni, ["k:uk"], "inner")
        got = sorted(tuple(r) for r in df.collect())
        return got, df._jdf.queryExecution().executedPlan().toString()

    got, plan = _with_conf(spark, SKEW_CONF, run)
    want = sorted(tuple(r) for r in spark.sql(
        "select * from sp_skew_main join sp_skew_uni on k = uk").collect())
    assert got == want and len(got) == n
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_first_seen_combines_map_side(spark):
    rows = [(i, "E1" if i % 3 == 0 else f"E{i}", f"21234567{i % 10}/9") for i in range(300)]
    df = spark.createDataFrame(rows, "i long, id string, phone string")
    mapped = L.contacts_map(df.select(F.array(F.lit(0).cast("bigint"), "i").alias("ord"),
                                      F.array("id", "phone").alias("cells")), 1, C.phone_numbers, False)
    copies = L.contacts_copies(mapped, 1, 0, 2)
    plan = copies._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan          # combined before the shuffle
    assert "Window" not in plan
    got = copies.collect()
    # the hot entity E1 shows each number at most once among the copies
    hot = [r.cells[1] for r in got if r.cells[0] == "E1"]
    assert len(hot) == len(set(hot))


def test_hot_value_mask(spark):
    """Masking moves no rows; its values are combined in each task first."""
    from sparkprep.operators import mask as M
    from sparkprep.session import work_path

    refs = work_path(spark, "test-skew-dicts", unique=True)
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None))
                                   .otherwise((F.col("id") % 500).cast("string")).alias("v"))
    rows = M.mask_columns(df, refs, {"v": "d"}).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.v, set()).add(None if r.id % 3 == 0 else str(r.id % 500))
    assert len(rows) == 30000 and all(len(vs) == 1 for vs in by_key.values()) and len(by_key) == 501
    plan = M.column_values(df, {"v": "d"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # one before the shuffle


def test_right_join_with_shared_names_can_be_split(spark):
    main = spark.range(30000).select(F.col("id").alias("oid"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"))
    uni = spark.range(1100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    main.createOrReplaceTempView("sp_skew_main2")
    uni.createOrReplaceTempView("sp_skew_uni2")

    def run(how):
        df = R.restrict_to_universe(main, uni, ["k:k"], how)
        key = lambda t: tuple((x is None, x or 0) for x in t)
        got = sorted((tuple(r) for r in df.collect()), key=key)
        want = sorted((tuple(r) for r in spark.sql(
            f"select m.*, u.* from sp_skew_main2 m {how} join sp_skew_uni2 u on m.k = u.k").collect()), key=key)
        assert got == want
        return df._jdf.queryExecution().executedPlan().toString()

    for how in ("right", "full"):
        plan = _with_conf(spark, SKEW_CONF, lambda: run(how))  # noqa: B023
        assert "skew=true" in plan and "RightOuter" not in plan and "FullOuter" not in plan
