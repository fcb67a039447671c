"""Dirty-file repair: golden cases (FIXTURES.md D1, D3, D5, D8) and the
whole chain against a brute-force model on lines built from `customer`."""
from pyspark.sql import functions as F

from sparkprep.operators import lines as L
from tests import bruteforce as B


def lines_df(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")


def test_repair_quotes(spark):
    df = lines_df(spark, ["h", 'a;"b;c";d;"e;f";"g;h', "a;b"])
    got = [r.line for r in L.repair_quoted_delimiters(df).orderBy("line_no").collect()]
    assert got == ["h", 'a;"bc";d;"ef";"g;h', "a;b"]


def test_malformed(spark):
    df = lines_df(spark, ["a;b;c", "1;2;3", "1;2", "1;2;3;4"])
    got = sorted((r.line_no, r.n_cells) for r in L.malformed_lines(df, ";").collect())
    assert got == [(2, 2), (3, 4)]


def test_excess_cells(spark):
    spec = L.LineSpec(header=["id", "name", "email", "phone"], delimiter="|", email_pos=2, phone_pos=3)
    df = lines_df(spark, ["id|name|email|phone", "E1|Ana|912345678|a@x.pt|211111111"])
    rows = L.repair_excess_cells(L.to_rows(df, "|"), spec)
    got = sorted((r.ord, "|".join(r.cells)) for r in rows.collect())
    assert got == [([0, 1], "E1|Ana|a@x.pt|211111111"), ([1, 0, 1, 0], "E1|Ana|a@x.pt|912345678")]


def test_first_seen_phones(spark):
    spec = L.LineSpec(header=["id", "phone"], delimiter="|", id_pos=0, phone_pos=1, email_pos=1)
    df = lines_df(spark, ["id|phone", "E1|212345678/9", "E1|911111111", "E1|212345678 212345679 933333333",
                          "E2|212345679 212345678"])
    rows = L.explode_phones(L.to_rows(df, "|"), spec)
    got = sorted((tuple(r.ord), r.cells[1]) for r in rows.collect())
    assert got == [((0, 1), "212345678"), ((0, 2), "911111111"), ((0, 3), "212345678"),
                   ((0, 4), "212345679"), ((2, 0, 1, 1), "212345679"), ((2, 0, 3, 2), "933333333"),
                   ((2, 0, 4, 1), "212345678")]


def test_merge_name(spark):
    spec = L.LineSpec(header=["id", "name", "country", "x"], delimiter="|", content_after_name=["PT"],
                      max_cells=4)
    df = lines_df(spark, ["h", "7|Ana|Silva|PT|x", "7|Ana|PT|x"])
    got = sorted("|".join(r.cells) for r in L.merge_split_name(L.to_rows(df, "|"), spec).collect())
    assert got == ["7|Ana Silva|PT|x", "7|Ana|PT|x"]


def test_chain_matches_bruteforce(spark, sf_dir):
    from sparkprep.queries import contacts as Q
    lines = Q.contact_lines(spark, sf_dir)
    spec = Q.CONTACT_SPEC
    got = L.lines_to_table(lines, spec, keep_order=True, on_error="keep")
    got = [tuple(r[1:len(spec.header) + 1]) + (r["_extra"],) for r in got.orderBy("ord").collect()]
    raw = [r.line for r in lines.orderBy("line_no").collect()]
    want = B.chain(raw[1:], spec)
    want = [tuple(c[:spec.width] + [None] * (spec.width - len(c))) + (spec.delimiter.join(c[spec.width:]) or None,) for c in want]
    assert got == want


def test_excess_same_number_twice(spark):
    spec = L.LineSpec(header=["id", "name", "email", "phone"], delimiter="|", email_pos=2, phone_pos=3)
    df = lines_df(spark, ["id|name|email|phone", "E1|Ana|911111111|911111111|a@x.pt|2", "E1|Ana|911111111|a@x.pt|3"])
    rows = L.repair_excess_cells(L.to_rows(df, "|"), spec)
    got = sorted((tuple(r.ord), "|".join(r.cells)) for r in rows.collect())
    assert got == [((0, 1), "E1|Ana|a@x.pt|2"), ((0, 2), "E1|Ana|a@x.pt|3"),
                   ((1, 0, 1, 0), "E1|Ana|a@x.pt|911111111"), ((1, 0, 1, 1), "E1|Ana|a@x.pt|911111111")]
