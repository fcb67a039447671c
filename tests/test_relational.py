"""Relational operators: universe joins (all types, multi-key, null keys),
time parameters, date parts, look-back."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import relational as R


@pytest.fixture(scope="module")
def frames(spark):
    main = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 20, "c"), (4, None, "d"), (5, 30, "e")],
                                 "id int, k int, v string")
    uni = spark.createDataFrame([(10, "x"), (40, "y"), (None, "z")], "uk int, label string")
    return main, uni


@pytest.mark.parametrize("how,sql", [("inner", "inner join"), ("left", "left join"), ("right", "right join"),
                                     ("full", "full outer join")])
def test_universe_join_types(spark, frames, how, sql):
    main, uni = frames
    main.createOrReplaceTempView("sp_t_main")
    uni.createOrReplaceTempView("sp_t_uni")
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    want = sorted((tuple(r) for r in spark.sql(f"select * from sp_t_main {sql} sp_t_uni on k = uk").collect()), key=key)
    got = sorted((tuple(r) for r in R.restrict_to_universe(main, uni, ["k:uk"], how).collect()), key=key)
    assert got == want


def test_universe_semi_anti_and_none(frames):
    main, uni = frames
    assert sorted(r.id for r in R.restrict_to_universe(main, uni, ["k:uk"], "semi").collect()) == [1, 2]
    assert sorted(r.id for r in R.restrict_to_universe(main, uni, ["k:uk"], "anti").collect()) == [3, 4, 5]
    assert R.restrict_to_universe(main, None, ["k:uk"]) is main
    with pytest.raises(ValueError):
        R.restrict_to_universe(main, uni, ["k:uk"], "sideways")


def test_universe_multi_key(spark):
    main = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], "x int, y string, v int")
    uni = spark.createDataFrame([(1, "a"), (2, "b")], "ux int, uy string")
    got = [r.v for r in R.restrict_to_universe(main, uni, ["x:ux", "y:uy"], "inner").collect()]
    assert got == [1]


def test_time_params():
    args = R.time_params({"date_obj": dt.datetime(2020, 1, 17, 9, 30),
                          "month": {"format": "%Y%m%d", "ref": "yyyymm01_000000"},
                          "year": {"format": "%Y-%m-%d", "ref": "yyyy0101_000000"},
                          "now": {"format": "%Y%m%d_%H%M%S"}})
    assert args == {"month": "20200101", "year": "2020-01-01", "now": "20200117_093000"}
    with pytest.raises(ValueError):
        R.time_params({"now": {"format": "%Y"}})


def test_date_parts_and_look_back(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 3),), (dt.datetime(2021, 3, 1),), (dt.datetime(2021, 2, 28),)],
                               "t timestamp")
    got = {r.date_part: r.n for r in R.group_by_date_part(df, "t", "week", F.count("*").alias("n")).collect()}
    assert got == {53: 1, 9: 1, 8: 1}
    with pytest.raises(ValueError):
        R.group_by_date_part(df, "t", "QUARTER", F.count("*"))
    kept = R.look_back(df, "t", dt.datetime(2021, 3, 31), "date_part", 1, "MONTH").collect()
    assert sorted(r.t for r in kept) == [dt.datetime(2021, 2, 28), dt.datetime(2021, 3, 1)]


def test_universe_keys_in_any_case(spark):
    main = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, v string")
    uni = spark.createDataFrame([(2, 3)], "ID int, w int")
    assert [tuple(r) for r in R.restrict_to_universe(main, uni, ["id:id"]).collect()] == [(2, "b", 2, 3)]
    with pytest.raises(ValueError, match="names 0"):
        R.restrict_to_universe(main, uni, ["key:id"])
