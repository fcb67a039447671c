"""Readers: delimited text, raw lines, unnamed columns, two-row headers."""
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from sparkprep.sources import delimited as DL
from sparkprep.sources import headers as H
from sparkprep.sources import raw_lines as RL


def _write(text, name="f.csv", encoding="utf-8"):
    d = tempfile.mkdtemp(prefix="sparkprep-src-")
    p = os.path.join(d, name)
    with open(p, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return p


def test_read_delimited_basic(spark):
    p = _write("a;b;a\n1;x;2\n3;NA;4\n5;6\n7;8;9;10\n")
    df = DL.read_delimited(spark, p, delimiter=";")
    assert df.columns == ["a", "b", "a.1"]
    assert [tuple(r) for r in df.collect()] == [("1", "x", "2"), ("3", None, "4"), ("5", "6", None)]


def test_read_delimited_header_row_and_names(spark):
    p = _write("junk\nmore junk\nx,y\n1,2\n3,4\n")
    df = DL.read_delimited(spark, p, header_row=2, names=["p", "q"])
    assert df.columns == ["p", "q"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4")]


def test_read_delimited_quotes_and_blank_header(spark):
    p = _write('id,,name\n1,"a,b",x\n')
    df = DL.read_delimited(spark, p)
    assert df.columns == ["id", "Unnamed: 1", "name"]
    assert H.drop_unnamed(df).collect()[0].asDict() == {"id": "1", "name": "x"}


def test_raw_lines_order_across_splits(spark):
    lines = [f"line {i:05d}" for i in range(3000)]
    p = _write("\n".join(lines) + "\n", "big.txt")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = RL.read_raw_lines(spark, p)
        assert df.rdd.getNumPartitions() > 3
        got = sorted((r.line_no, r.line) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_raw_lines_windows_1252(spark):
    p = _write("café;1\nnaïve;2\n", "w.txt", encoding="windows-1252")
    df = RL.read_raw_lines(spark, p, encoding="ANSI")
    assert sorted((r.line_no, r.line) for r in df.collect()) == [(0, "café;1"), (1, "naïve;2")]


def test_flatten_header_fixture(spark):
    top = ["Sales 2019", "Unnamed: 1", "Sales 2020", "Unnamed: 3"]
    rows = [(0, "q1", "q2", "q1", "q2"), (1, "1", "2", "3", "4")]
    df = spark.createDataFrame(rows, ["line_no", *top])
    year = H.flatten_multilevel_header(df, ["Sales"], ["s"], "year")
    assert year.columns == ["s_q1_2019", "s_q2_2019", "s_q1_2020", "s_q2_2020"]
    assert [tuple(r) for r in year.collect()] == [("1", "2", "3", "4")]
    last = H.flatten_multilevel_header(df, ["Sales"], ["s"])
    assert last.columns == ["s_q1", "s_q2"]
    assert [tuple(r) for r in last.collect()] == [("3", "4")]


def test_read_two_row_header(spark):
    p = _write("Sales 2019,,Sales 2020,\nq1,q2,q1,q2\n1,2,3,4\n5,6,7,8\n")
    df = H.read_two_row_header(spark, p, ["Sales"], ["s"], "year")
    assert df.columns == ["s_q1_2019", "s_q2_2019", "s_q1_2020", "s_q2_2020"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3", "4"), ("5", "6", "7", "8")]


def test_read_delimited_blank_lines(spark):
    p = _write("\njunk\n\nx,y\n1,2\n\n3,4\n")
    df = DL.read_delimited(spark, p, header_row=1)
    assert df.columns == ["x", "y"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4")]
    p0 = _write("x,y\n\n1,2\n")
    assert [tuple(r) for r in DL.read_delimited(spark, p0).collect()] == [("1", "2")]


def test_read_delimited_quotes_and_backslashes(spark):
    p = _write('a,b\n1,"say ""hi"" now"\n2,"p ""q"", r"\n"C:\\",x\n5" pipe,y\n,"it\'s; ""\n')
    df = DL.read_delimited(spark, p)
    with pytest.raises(Exception, match="not closed"):
        df.collect()
    p = _write('a,b\n1,"say ""hi"" now"\n2,"p ""q"", r"\n"C:\\",x\n5" pipe,y\n')
    got = [tuple(r) for r in DL.read_delimited(spark, p).collect()]
    assert got == [("1", 'say "hi" now'), ("2", 'p "q", r'), ("C:\\", "x"), ('5" pipe', "y")]


def test_read_delimited_line_breaks_in_cells(spark):
    p = _write('a,b\n1,"x\ny"\n2,z\n')
    assert [tuple(r) for r in DL.read_delimited(spark, p, multi_line=True).collect()] == [("1", "x\ny"), ("2", "z")]
    with pytest.raises(Exception, match="multi_line"):
        DL.read_delimited(spark, p).collect()


def test_read_delimited_names_must_fit(spark):
    with pytest.raises(ValueError, match="2 names for 3"):
        DL.read_delimited(spark, _write("a,b,c\n1,2,3\n"), names=["p", "q"])


def test_read_delimited_long_rows(spark):
    p = _write("a,b\n1,2\n3,4,5,6\n7\n")
    assert [tuple(r) for r in DL.read_delimited(spark, p).collect()] == [("1", "2"), ("7", None)]
    kept = DL.read_delimited(spark, p, long_rows="keep")
    assert [tuple(r) for r in kept.collect()] == [("1", "2", None), ("3", "4", "5,6"), ("7", None, None)]
    with pytest.raises(Exception, match="more than 2 cells"):
        DL.read_delimited(spark, p, long_rows="fail").collect()


def test_read_delimited_header_rows_of_every_file(spark):
    d = tempfile.mkdtemp(prefix="sparkprep-src-")
    for i in range(3):
        with open(os.path.join(d, f"p{i}.csv"), "w") as f:
            f.write(f"note\n\nx,y\n{i},a\nx,y\n")
    for row, want in ((1, 6), ):
        df = DL.read_delimited(spark, d, header_row=row)
        assert df.columns == ["x", "y"]
        assert sorted(tuple(r) for r in df.collect()) == [("0", "a"), ("1", "a"), ("2", "a")] + [("x", "y")] * 3 and want == df.count()


def test_raw_lines_blank_lines_in_any_charset(spark):
    text = "é\n\n  \nb\n\n"
    for name in ("utf-8", "windows-1252"):
        p = _write(text, f"{name}.txt", encoding=name)
        got = sorted((r.line_no, r.line) for r in RL.read_raw_lines(spark, p, "ANSI" if name != "utf-8" else name).collect())
        assert got == [(0, "é"), (1, ""), (2, "  "), (3, "b"), (4, "")]


def test_two_row_header_on_a_folder(spark):
    """The header is in the first file by name, also if a later one is larger."""
    d = tempfile.mkdtemp(prefix="sparkprep %41 src-")
    with open(os.path.join(d, "a b.csv"), "w") as f:
        f.write("Sales 2019,,Sales 2020,\nq1,q2,q1,q2\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.writelines(f'{i},"say ""{i}""",{i},4\n' for i in range(2000))
    df = H.read_two_row_header(spark, d, ["Sales"], ["s"], "year")
    assert df.columns == ["s_q1_2019", "s_q2_2019", "s_q1_2020", "s_q2_2020"]
    assert df.count() == 2000 and df.where("s_q1_2019 = '7'").first()["s_q2_2019"] == 'say "7"'


BREAKS = ('a,b,c\r\n1,"x\r\ny",2\n\n  \n3,"say ""hi""\n\n, ""z""",4\n5" pipe,q"r,6\n"","",7\n8,"one, two",9\n'
          '10,"""quoted"" at the start",11\n"12\n",,\n13,"a\n\nb\n\n\nc",x\n14,plain,y')


@pytest.mark.parametrize("split", [None, 11, 40])
def test_line_breaks_in_cells_in_any_splits(spark, split):
    """One file read in splits of a few bytes equals the plain reader."""
    import csv
    import io

    want = [r for r in csv.reader(io.StringIO(BREAKS.replace("\r\n", "\n"))) if any(x.strip() for x in r)][1:]
    p = _write(BREAKS)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = DL.read_delimited(spark, p, multi_line=True, na_values=[])
        got = sorted(tuple(x or "" for x in r) for r in df.collect())
        assert got == sorted(map(tuple, want))
        assert split is None or df.rdd.getNumPartitions() > 4
        # A header below, on a folder of two such files.
        d = tempfile.mkdtemp(prefix="sparkprep-src-")
        for i in range(2):
            with open(os.path.join(d, f"f{i}.csv"), "w", newline="") as f:
                f.write('note "x"\n\n' + BREAKS)
        both = DL.read_delimited(spark, d, header_row=1, multi_line=True, na_values=[])
        assert both.columns == ["a", "b", "c"]
        assert sorted(tuple(x or "" for x in r) for r in both.collect()) == sorted(map(tuple, want * 2))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_quote_open_at_the_end_of_the_file(spark):
    with pytest.raises(Exception, match="not closed at the end"):
        DL.read_delimited(spark, _write('a,b\n1,"x\n2,y\n'), multi_line=True).collect()


WIDE = "k,v\r\n\u0a05\u4e00,\u0a0a\u0100\n\n  \nΩ,\U0001f600\n\u0a00\u000b\u0a00,é\nlast,\u0d0a"


@pytest.mark.parametrize("name,mark,split,end", [
    ("utf-16-le", b"", 17, ""), ("utf-16-be", b"", 50, "\u0a0d"), ("utf-16", b"\xff\xfe", 31, "\n"), ("utf-16", b"\xfe\xff", 17, "\n\n"),
    ("utf-32-le", b"", 50, "\u0a0d"), ("utf-32-be", b"", 31, "\n"), ("utf-32", b"\x00\x00\xfe\xff", None, ""), ("utf-16-le", b"", None, "\u0a0d")])
def test_wide_charsets_in_any_splits(spark, name, mark, split, end):
    codec = name if not mark else f"{name}-{'le' if mark[0] == 255 else 'be'}"
    d = tempfile.mkdtemp(prefix="sparkprep-src-")
    p = os.path.join(d, "f.txt")
    with open(p, "wb") as f:
        f.write(mark + (WIDE + end).encode(codec))
    encoding = name if mark else name.replace("-le", "le").replace("-be", "be")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = sorted((r.line_no, r.line) for r in RL.read_raw_lines(spark, p, encoding).collect())
        text = (WIDE + end).replace("\r\n", "\n")
        assert got == list(enumerate((text[:-1] if text.endswith("\n") else text).split("\n")))
        rows = DL.read_delimited(spark, p, encoding=encoding)
        assert rows.columns == ["k", "v"]
        assert sorted(tuple(r) for r in rows.collect()) == sorted(
            tuple(x.split(",")) for x in text.split("\n")[1:] if x.strip())
        skipped = RL.read_raw_lines(spark, p, encoding, skip_blank=True, across_files=True).where("line_no = 2").first()["line"]
        assert skipped == "Ω,\U0001f600"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_two_row_header_by_the_rules_of_delimited(spark):
    text = 'Sales 2019,,Sales 2020,\nq1,q2,q1,q2\n\n1,NA,3,4\n5,6,7,8,9\n"x, y",2,3\n'
    df = H.read_two_row_header(spark, _write(text), ["Sales"], ["s"], "year")
    assert sorted(tuple(r) for r in df.collect()) == [("1", None, "3", "4"), ("x, y", "2", "3", None)]
    with pytest.raises(Exception, match="more than 4 cells"):
        H.read_two_row_header(spark, _write(text), ["Sales"], ["s"], "year", long_rows="fail").collect()
    broken = 'Sales 2019,,Sales 2020,\nq1,q2,q1,q2\n1,"a\nb",3,4\n'
    with pytest.raises(Exception, match="not closed"):
        H.read_two_row_header(spark, _write(broken), ["Sales"], ["s"], "year").collect()
    df = H.read_two_row_header(spark, _write(broken), ["Sales"], ["s"], "year", multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "a\nb", "3", "4")]


def test_ordered_lines_without_counting(spark):
    """The places sort as the lines stand, over splits and files; nothing is aggregated or moved."""
    d = tempfile.mkdtemp(prefix="sparkprep %20 src-")
    want = []
    for name in ("b file.txt", "a.txt", "c.txt"):
        lines = [f"{name} {i}" for i in range(700 if name[0] == "b" else 90)]
        want.append((name, lines))
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    want = [line for _, lines in sorted(want) for line in lines]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        rows, header = RL.read_ordered_lines(spark, d)
        assert rows.rdd.getNumPartitions() > 4
        got = [r.line for r in sorted(rows.collect(), key=lambda r: r.ord)]
        one, first = RL.read_ordered_lines(spark, os.path.join(d, "a.txt"))
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert header == want[0] and got == want[1:] and first == "a.txt 0"
    assert not any(x in plan for x in ("Aggregate", "Exchange", "Join", "Sort")) and plan.count("FileScan") == 1
    wide = os.path.join(d, "w16")
    with open(wide, "wb") as f:
        f.write("h;k\n1;ਅ一\n\n2;x\n".encode("utf-16"))
    rows, header = RL.read_ordered_lines(spark, wide, "utf-16")
    assert header == "h;k" and [r.line for r in sorted(rows.collect(), key=lambda r: r.ord)] == ["1;ਅ一", "", "2;x"]
    with pytest.raises(Exception):
        RL.read_ordered_lines(spark, os.path.join(d, "none"))
