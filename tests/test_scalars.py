"""Golden cases for the scalar standardisers (FIXTURES.md section 2)."""
import pytest
from pyspark.sql import functions as F

from sparkprep.functions import dates as D
from sparkprep.functions import numbers as N
from sparkprep.functions import text as T
from sparkprep.operators import standardize as S


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def test_clean_string(spark):
    df = one_col(spark, ["João D.", "A-B_c 1", "Fernando None", "banana", None])
    got = [r[0] for r in df.orderBy("i").select(T.clean_string("v")).collect()]
    assert got == ["joãod", "ab_c1", "ferdo", "baa", ""]


def test_clean_string_whole_value(spark):
    df = one_col(spark, ["banana", "NaN", "None"])
    got = [r[0] for r in df.orderBy("i").select(T.clean_string("v", whole_value_only=True)).collect()]
    assert got == ["banana", "", ""]


def test_clean_tax_id(spark):
    df = one_col(spark, [" 123.0 ", None, "PT-12", "NaN", "A_1", "", "12 3"])
    got = [r[0] for r in df.orderBy("i").select(T.clean_tax_id("v")).collect()]
    assert got == ["123", "0", "pt012", "0", "a_1", "", "1203"]


def test_clean_int(spark):
    vals = ["1.234.567", "1,5", "-5", " 1 2 ", "abc", None, ".5", "1.2.3.4"]
    df = one_col(spark, vals)
    got = [r[0] for r in df.orderBy("i").select(N.clean_int("v")).collect()]
    assert got == [1234, 1, 0, 12, 0, 0, 0, 123]


def test_standardize_name():
    assert [T.standardize_name(n) for n in ["Nº Cliente", "AÇÃO", "a.b", "X_1"]] == \
        ["n__cliente", "ac_o", "a.b", "x_1"]


@pytest.mark.parametrize("values,decimal,expected", [
    (["1.234.567", "12,5", None], None, [1234567.0, 12.5, 0.0]),
    (["1.234,56", "7", "-1.234,56"], None, [1234.56, 7.0, -1234.56]),
    (["1,234,567", "3.5"], None, [1234567.0, 3.5]),
    (["12%", "1,5"], None, [12.0, 1.5]),
    (["12:30", ".", "-1", None, ""], None, [0.0, 0.0, 0.0, 0.0, 0.0]),
    (["1,234.56", "2"], ".", [1234.56, 2.0]),
    (["1.234", "1.5"], ",", [1234.0, 1.5]),
])
def test_clean_float(spark, values, decimal, expected):
    df = one_col(spark, values)
    got = [r["v"] for r in S.floats(df, ["v"], decimal=decimal).orderBy("i").collect()]
    assert got == expected


def test_clean_float_error(spark):
    df = one_col(spark, ["1,234.56"])
    with pytest.raises(Exception):
        S.floats(df, ["v"]).collect()
    got = S.floats(df, ["v"], on_error="sentinel").collect()[0]["v"]
    assert got == 0.0


@pytest.mark.parametrize("value,fmt,expected", [
    (None, "%Y-%m-%d", ""),
    ("12", "%Y-%m-%d", ""),
    ("2020-03-05", "%Y-%m-%d", "20200305_000000"),
    ("2020-3-5", "%Y-%m-%d", "20200305_000000"),
    ("2020-03-05 10:11:12.123", "%Y-%m-%d %H:%M:%S.", "20200305_101112"),
    ("2020-03-05 00:00", "%Y-%m-%d0", "20200305_000000"),
    ("05/03/2020", ["%Y-%m-%d", "%d/%m/%Y"], "20200305_000000"),
    ("05/03/99", "%d/%m/%y", "19990305_000000"),
    ("05/03/68", "%d/%m/%y", "20680305_000000"),
    ("20200305", "%Y%m%d", "20200305_000000"),
])
def test_clean_date(spark, value, fmt, expected):
    df = one_col(spark, [value])
    assert df.select(D.clean_date("v", fmt)).collect()[0][0] == expected


def test_clean_date_error(spark):
    df = one_col(spark, ["2020-02-30"])
    with pytest.raises(Exception):
        df.select(D.clean_date("v", "%Y-%m-%d")).collect()
    assert df.select(D.clean_date("v", "%Y-%m-%d", on_error="sentinel")).collect()[0][0] == ""


def test_spark_pattern():
    assert D.spark_pattern("%Y-%m-%d") == "yyyy-M-d"
    assert D.spark_pattern("%Y%m%d_%H%M%S") == "yyyyMMdd_HHmmss"
    assert D.spark_pattern("%d/%m/%Y T%H") == "d/M/yyyy' T'H"


def test_choose_format():
    p = {"cols": "a,b", "a": "%Y", "other_formats": "%d", "mix": "%m,%d", "global_format": "%H"}
    assert D.choose_format("a", p) == "%Y"
    assert D.choose_format("b", p) == "%d"
    assert D.choose_format("b", {"mix": "%m,%d", "global_format": "%H"}) == ["%m", "%d"]
    assert D.choose_format("b", {"global_format": "%H"}) == "%H"


def test_detect_format(spark):
    df = one_col(spark, ["2020-03-05", "05/03/2020", "x"])
    got = [r[0] for r in df.orderBy("i").select(D.detect_format("v", ["%Y-%m-%d", "%d/%m/%Y"])).collect()]
    assert got == ["%Y-%m-%d", "%d/%m/%Y", None]


def test_anchor(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 1, 17),), (dt.datetime(2020, 3, 17),)], "t timestamp")
    got = [r[0] for r in df.select(F.date_format(D.anchor_date("t", "yyyymm01_000000"), "yyyyMMdd")).collect()]
    assert got == ["20200101", "20200301"]
    got = [r[0] for r in df.select(F.date_format(D.anchor_date("t", "yyyy0101_000000"), "yyyyMMdd")).collect()]
    assert got == ["20200101", "20200101"]
    assert D.anchor_python(dt.datetime(2020, 1, 17), "yyyymm01_000000") == dt.datetime(2020, 1, 1)


def test_freshness(spark):
    import datetime as dt
    now = dt.datetime(2024, 1, 15)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 8),), (dt.datetime(2024, 1, 7),)], "t timestamp")
    got = [r[0] for r in df.select(D.is_stale(F.col("t"), F.lit(now), "day", 7)).collect()]
    assert got == [False, True]
    got = [r[0] for r in df.select(D.is_stale(F.col("t"), F.lit(now), None, 7)).collect()]
    assert got == [True, True]


def test_look_back(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 3, 31),)], "t timestamp")
    r = df.select((F.col("t") - D.look_back_interval("date_part", 2, "WEEK")).alias("a"),
                  (F.col("t") - D.look_back_interval("date_part", 1, "MONTH")).alias("b"),
                  (F.col("t") - D.look_back_interval("days", 5)).alias("c")).collect()[0]
    assert r.a == dt.datetime(2020, 3, 17)
    assert r.b == dt.datetime(2020, 2, 29)
    assert r.c == dt.datetime(2020, 3, 26)


def test_quarantine(spark):
    from sparkprep.plans import process as P
    df = spark.createDataFrame([("2020-01-02", "1,5", "7"), ("2020-02-30", ":15", "99999999999999999999"),
                                (None, None, None)], "d string, f string, i string")
    out = P.standardize_table(df, {"date_cols": {"cols": "d", "global_format": "%Y-%m-%d"},
                                   "float_cols": "f", "int_cols": "i"}, on_error="quarantine")
    got = [tuple(r) for r in out.collect()]
    assert out.columns == ["d", "f", "i", "_errors"]
    assert got[0] == ("20200102_000000", 1.5, 7, [])
    assert got[1] == ("", 0.0, 0, ["d", "f", "i"])
    assert got[2] == ("", 0.0, 0, [])


def test_look_back_fixture_units(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 3, 31),)], "t timestamp")
    r = df.select((F.col("t") - D.look_back_interval("date_part", 5, "DOY")).alias("doy"),
                  (F.col("t") - D.look_back_interval("date_part", 5, "DAY")).alias("day"),
                  (F.col("t") - D.look_back_interval("date_part", 3, "MONTH")).alias("month"),
                  (F.col("t") - D.look_back_interval("hours", 6)).alias("hours")).collect()[0]
    assert r.doy == r.day == dt.datetime(2020, 3, 26)
    assert r.month == dt.datetime(2019, 12, 31)
    assert r.hours == dt.datetime(2020, 3, 30, 18)
    with pytest.raises(ValueError):
        D.look_back_interval("fortnight", 1)
    with pytest.raises(ValueError):
        D.look_back_interval("date_part", 1, "QUARTER")


def test_dates_do_not_depend_on_the_time_zone(spark):
    """01:30 on the day clocks go forward does not exist in Lisbon."""
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2020-03-29 01:30:00",), ("2020-10-25 01:30:00",), ("1900-01-01 00:00:00",)], "v string")
    try:
        for zone in ("Europe/Lisbon", "America/Sao_Paulo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(D.clean_date("v", "%Y-%m-%d %H:%M:%S")).collect()]
            assert got == ["20200329_013000", "20201025_013000", "19000101_000000"]
            assert str(df.select(D.clean_date("v", "%Y-%m-%d %H:%M:%S", as_timestamp=True)).first()[0]) == "2020-03-29 01:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_anchor_template_must_be_whole():
    with pytest.raises(ValueError):
        D.anchor_python(__import__("datetime").datetime(2020, 1, 1), "yyyxmm01_000000")


def test_formats_are_tried_by_shape(spark):
    """The first format that parses wins, as if all were tried in order; each
    value is tried only with the formats of its shape."""
    from functools import reduce

    formats = ["%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d", "%Y%m%d", "%d %b %Y", "%d/%m/%Y %H:%M", "%Y-%m-%dT%H:%M:%S", "%d.%m.%y", "Q%m-%Y", "%I:%M %p %d/%m/%Y"]
    values = ["31/12/2020", "12/31/2020", "1/2/2021", "2020-02-30", "2020-2-3", "20200229", "20210229", "3 Mar 2020", "3 Xyz 2020", "1/1/2020 9:05",
              "2020-01-02T03:04:05", "1.2.69", "1.2.68", "Q3-2020", "q3-2020", "11:05 PM 01/02/2020", "", None, " 1/1/2020", "1/1/2020 ", "99/99/9999",
              "Q13-2020", "2020--1-1", "٣/٤/2020", "abc", "1/2/20"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    one_by_one = F.coalesce(*[D.parse_timestamp(v, f) for f in formats])
    name = reduce(lambda rest, f: F.when(D.parse_timestamp(v, f).isNotNull(), F.lit(f)).otherwise(rest), reversed(formats), F.lit(None))
    rows = df.select("v", D.parse_date_value(v, formats).cast("string").alias("a"), one_by_one.cast("string").alias("b"),
                     D.detect_format(v, formats).alias("c"), name.alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in rows), [r for r in rows if r.a != r.b or r.c != r.d]
    assert sum(r.a is not None for r in rows) > 10
    assert [D.format_mask(f) for f in ("%d/%m/%Y", "%Y%m%d", "%d %b %Y", "%Y-%m-%dT%H:%M:%S")] == ["9/9/9", "9", "9 a 9", "9-9-9a9:9:9"]
