"""Standardisation on a stream: row-wise operators and foreachBatch."""
import pytest

from sparkprep.session import work_path
from sparkprep.streaming import standardize as ST


def test_stream_row_wise_and_batches(spark):
    src = work_path(spark, "test-stream-src", unique=True)
    spark.createDataFrame([("Ana", "1.234,56", " 7 "), ("Rui", "12,30", "x")],
                          "name string, amount string, qty string").write.mode("overwrite").parquet(src)
    schema = "name string, amount string, qty string"
    stream = spark.readStream.schema(schema).parquet(src)
    types = {"str_cols": "name", "float_cols": "amount", "int_cols": "qty"}
    flags = {"amount": {"md": 1, "d1": 1, "mc": 1, "c1": 1, "pc": 0}}
    out = ST.standardize_stream(stream, types, flags)
    q = out.writeStream.format("memory").queryName("sp_stream_test").outputMode("append") \
        .option("checkpointLocation", work_path(spark, "test-stream-ck", unique=True)).start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("select * from sp_stream_test").collect())
    assert got == [("ana", 1234.56, 7), ("rui", 12.3, 0)]

    dst = work_path(spark, "test-stream-out", unique=True)
    ck = work_path(spark, "test-stream-ck2", unique=True)
    for extra in (None, ("Eva", "2,00", "9")):
        # The second start goes on where the first has ended.
        if extra:
            spark.createDataFrame([extra], schema).write.mode("append").parquet(src)
        q2 = ST.start_standardize(spark.readStream.schema(schema).parquet(src), types, dst, checkpoint=ck,
                                  trigger={"availableNow": True})
        q2.awaitTermination(120)
    res = sorted((r.name, r.amount, r.qty) for r in spark.read.parquet(dst).collect())
    assert res == [("ana", 1234.56, 7), ("eva", 2.0, 9), ("rui", 12.3, 0)]
    with pytest.raises((TypeError, ValueError)):
        ST.start_standardize(spark.readStream.schema(schema).parquet(src), types, dst)


def test_batches_agree_with_one_table(spark):
    """The second batch tells that commas group digits: the first is written again under the flags of both."""
    from sparkprep.plans import process as P

    types = {"str_cols": "name", "float_cols": "amount,rate", "decimal": "."}
    parts = [[("a", "1,50", "5"), ("b", "12,345", "7.5")], [("c", "1,234,567.89", "10%"), ("d", "3,25", "x1" * 0 + "2")], [("e", "4", "")]]
    schema = "name string, amount string, rate string"
    whole = spark.createDataFrame([r for p in parts for r in p], schema)
    want = sorted(map(tuple, P.standardize_table(whole, types, on_error="sentinel").collect()))
    dst = work_path(spark, "test-stream-flags", unique=True)
    run = ST.standardize_batches(types, dst, on_error="sentinel")
    for i in (0, 1, 1, 2, 0):   # two batches come again, as after a failure
        run(spark.createDataFrame(parts[i], schema), i)
    got = spark.read.parquet(dst)
    assert sorted((r.name, r.amount, r.rate) for r in got.collect()) == want
    alone = P.standardize_table(spark.createDataFrame(parts[0], schema), types, on_error="sentinel").collect()
    assert sorted(map(tuple, alone)) != [t for t in want if t[0] in "ab"]
