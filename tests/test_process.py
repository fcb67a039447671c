"""Pipeline: F1 spec handling, F2 freshness and input choice, names, coverage."""
import datetime as dt

from pyspark.sql import functions as F

from sparkprep.operators import names as NM
from sparkprep.plans import process as P
from sparkprep.plans import script as SC
from sparkprep.session import work_path


def test_expand_wildcards():
    spec = {"str_cols": "a,b_#all-cols-starts-with#",
            "date_cols": {"cols": "d_#all-cols-starts-with#", "d_#all-cols-starts-with#": "%Y"}}
    out = NM.expand_wildcards(spec, ["a", "b1", "b2", "d1", "c"])
    assert out["str_cols"] == "a,b1,b2"
    assert out["date_cols"]["cols"] == "d1"
    assert out["date_cols"]["d1"] == "%Y"


def test_type_coverage(spark):
    df = spark.createDataFrame([(1, None, "x", "2020-01-01"), (2, "y", "z", "2020-02-30")],
                               "a int, b string, c string, d string")
    rep = NM.type_coverage(df, {"int_cols": "a", "str_cols": "b,a", "nif_cols": "z",
                                "date_cols": {"cols": "d", "global_format": "%Y-%m-%d"}})
    got = {r.column: (r.status, r.n_null, r.n_unparsable) for r in rep.collect()}
    assert got == {"a": ("multiple", 0, 0), "b": ("ok", 1, 0), "c": ("undeclared", 0, None),
                   "d": ("ok", 0, 1), "z": ("missing", None, None)}


def test_standardize_table_names(spark):
    df = spark.createDataFrame([("João D.", " 12 ")], "Nome string, Qtd string")
    out = P.standardize_table(df, {"str_cols": "Nome", "int_cols": "Qtd"})
    assert out.columns == ["nome", "qtd"]
    assert tuple(out.collect()[0]) == ("joãod", 12)


def _spec(base):
    return {
        "raw_source": {"load_parameters": {"path": f"{base}/in", "file_name": "src", "file_type": "csv",
                                           "header_row": 0, "delimiter": ",", "encoding": "utf-8",
                                           "special_char": '"', "decimal": "."},
                       "type": {"specifics": "file"}},
        "data_types": {"str_cols": "name", "int_cols": "qty"},
        "processed_source": {"save_parameters": {"path": f"{base}/out", "tag": "src", "file_type": "parquet"}},
        "conf_file": {"refresh_rate": "day,7"},
    }


def test_process_source_freshness(spark):
    base = work_path(spark, "test-process", unique=True)
    for tag, rows in (("20240101_000000", [("A", "1")]), ("20240201_000000", [("B B", "2"), ("C", "x")])):
        (spark.createDataFrame(rows, "name string, qty string").write.option("header", True)
         .csv(f"{base}/in/src_{tag}.csv"))
    spec = _spec(base)
    first = P.process_source(spark, spec, now=dt.datetime(2024, 3, 1))
    assert first.status == "written"
    assert sorted((r.name, r.qty) for r in first.data.collect()) == [("bb", 2), ("c", 0)]
    again = P.process_source(spark, spec, now=dt.datetime(2024, 3, 5))
    assert again.status == "fresh"
    later = P.process_source(spark, spec, now=dt.datetime(2024, 3, 20))
    assert later.status == "written"
    old = P.process_source(spark, spec, src_time="20240115_000000")
    assert [(r.name, r.qty) for r in old.data.collect()] == [("a", 1)]


def test_run_script(spark):
    spark.range(10).createOrReplaceTempView("sp_t_numbers")
    steps = [SC.Step("sp_t_even", "select id from sp_t_numbers where id % 2 = :m", {"m": 0}),
             SC.Step("", "select count(*), max(id) from sp_t_even where id < :lim")]
    df = SC.run_script(spark, steps, ["n", "top"], args={"lim": 7})
    assert df.columns == ["n", "top"]
    assert tuple(df.collect()[0]) == (4, 6)


def test_process_source_quality_path(spark, sf_dir):
    """F2 on a dirty contacts file: raw lines -> repair chain -> standardise -> snapshot."""
    from sparkprep.queries import contacts as Q
    from tests import bruteforce as B

    base = work_path(spark, "test-quality", unique=True)
    lines = Q.contact_lines(spark, sf_dir)
    lines.orderBy("line_no").select("line").write.mode("overwrite").text(f"{base}/in/contacts.txt")
    s = Q.CONTACT_SPEC
    spec = {
        "raw_source": {"load_parameters": {"path": f"{base}/in", "file_name": "contacts", "file_type": "txt",
                                           "delimiter": ";", "encoding": "utf-8", "special_char": '"'},
                       "type": {"specifics": "file",
                                "quality": {"email_position": s.email_pos, "phone_position": s.phone_pos,
                                            "id_position": s.id_pos, "name_position": s.name_pos,
                                            "possible_content_after_name": ",".join(s.content_after_name),
                                            "max_cells": s.max_cells}}},
        "data_types": {"names": ",".join(s.header), "str_cols": "segment", "contact_cols": "email,phone"},
        "processed_source": {"save_parameters": {"path": f"{base}/out", "tag": "contacts"}},
    }
    spec["raw_source"]["type"]["quality"]["on_error"] = "keep"
    raw = [r.line for r in lines.orderBy("line_no").collect()]
    want = B.chain(raw[1:], s)
    assert any(len(c) > s.width for c in want)   # the fixture has over-wide rows
    res = P.process_source(spark, spec, src_time="20240301_000000")
    got = sorted(tuple(r[c] for c in s.header + ["_extra"]) for r in res.data.collect())
    import re

    def clean(v):
        v = (v or "").replace(" ", "").lower().replace("nan", "").replace("none", "")
        return re.sub(r"[^\w]", "", v)

    exp = []
    for c in want:
        cells = c[:s.width] + [None] * (s.width - len(c))
        exp.append(tuple(cells[:4]) + (clean(cells[4]),) + (";".join(c[s.width:]) or None,))
    assert got == sorted(exp)


def test_cli_runs_a_spec(spark, tmp_path):
    import json
    from sparkprep import cli

    base = work_path(spark, "test-cli", unique=True)
    (spark.createDataFrame([("Ana", "1")], "name string, qty string").write.option("header", True)
     .csv(f"{base}/in/src_20240101_000000.csv"))
    spec_file = tmp_path / "spec.json"
    spec_file.write_text(json.dumps(_spec(base)))
    assert cli.main([str(spec_file), "--src-time", "20240105_000000"]) == 0
    out = spark.read.parquet(f"{base}/out/master/src")
    assert [(r.name, r.qty, r.snapshot) for r in out.collect()] == [("ana", 1, "20240105_000000")]
    assert cli.main([str(spec_file), "--src-time", "20230101_000000"]) == 1   # no input that old


def test_process_source_date_part(spark):
    base = work_path(spark, "test-part", unique=True)
    (spark.createDataFrame([("Ana", "1")], "name string, qty string").write.option("header", True)
     .csv(f"{base}/in/src_20240101_000000.csv"))
    res = P.process_source(spark, _spec(base), src_time="20240102_000000", date_part="north")
    assert res.path.endswith("/out/master/src/src_north")
    assert [(r.name, r.qty) for r in res.data.collect()] == [("ana", 1)]


def test_run_sql_script_lazy(spark):
    import pytest
    spark.range(10).createOrReplaceTempView("sp_t_src")
    script = """CREATE OR REPLACE TEMPORARY VIEW sp_t_v1 AS SELECT id FROM sp_t_src WHERE id >= :lo;
                CREATE OR REPLACE TEMPORARY VIEW sp_t_v2 AS SELECT count(*) AS c FROM sp_t_v1"""
    df = SC.run_sql_script(spark, script, "sp_t_v2", ["n"], args={"lo": 4})
    assert "LocalTableScan" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.collect()[0].n == 6
    with pytest.raises(ValueError):
        SC.run_sql_script(spark, "SELECT 1", "sp_t_v2")


def test_process_source_query_input(spark, sf_dir):
    from sparkprep.queries.common import table
    table(spark, sf_dir, "orders").createOrReplaceTempView("sp_t_orders")
    base = work_path(spark, "test-query-src", unique=True)
    spec = {
        "raw_source": {"load_parameters": {"query": """select o_custkey, count(*) from sp_t_orders
                                                        where o_orderdate >= cast(:since as timestamp_ntz)
                                                          and o_orderstatus = :status group by o_custkey"""},
                       "type": {"specifics": "query"}},
        "query_manipulation": {"time": {"since": {"format": "%Y-%m-%d %H:%M:%S", "ref": "yyyy0101_000000"}},
                               "substitute_values": {"status": "F"}},
        "data_types": {"names": "Cliente,N Encomendas", "n_client_cols": "Cliente", "int_cols": "N Encomendas"},
        "processed_source": {"save_parameters": {"path": f"{base}/out", "tag": "orders_by_customer"}},
    }
    res = P.process_source(spark, spec, src_time="19990615_000000")
    got = sorted((r.cliente, r.n_encomendas) for r in res.data.collect())
    spark.sql("""select o_custkey, count(*) as n from sp_t_orders where o_orderdate >= timestamp '1999-01-01'
                 and o_orderstatus = 'F' group by o_custkey""").createOrReplaceTempView("sp_t_want")
    want = sorted((r.o_custkey, r.n) for r in spark.table("sp_t_want").collect())
    assert got == want and got


def test_process_source_test_mode(spark):
    base = work_path(spark, "test-mode", unique=True)
    (spark.createDataFrame([("Ana", "1")], "Nome string, Qtd string").write.option("header", True)
     .csv(f"{base}/in/src_20240101_000000.csv"))
    spec = _spec(base)
    spec["data_types"] = {"str_cols": "Nome", "int_cols": "Qtd"}
    spec["tests_params"] = {"standardize_cols_names": False}
    res = P.process_source(spark, spec, src_time="20240102_000000", test=True,
                           data_folder_tests=f"{base}/tests")
    assert res.path.startswith(f"{base}/tests")
    assert [c for c in res.data.columns if c != "snapshot"] == ["Nome", "Qtd"]
    normal = P.process_source(spark, spec, src_time="20240102_000000")
    assert [c for c in normal.data.columns if c != "snapshot"] == ["nome", "qtd"]


def test_process_source_trims_lists_and_passes_on_error(spark):
    base = work_path(spark, "test-lists", unique=True)
    (spark.createDataFrame([("Ana", "1", "1,5"), ("Rui", "2", "x")], "name string, qty string, amount string").write.option("header", True)
     .csv(f"{base}/in/src_20240101_000000.csv"))
    spec = _spec(base)
    spec["data_types"] = {"str_cols": "name,\n ", "int_cols": " qty", "float_cols": "amount "}
    spec["on_error"] = "quarantine"
    got = P.process_source(spark, spec, src_time="20240102_000000")
    assert [(r.name, r.qty, r.amount) for r in got.data.collect()] == [("ana", 1, 1.5)]
    assert [(r.name, r.qty, r.amount, r._errors) for r in got.rejected.collect()] == [("rui", 2, 0.0, ["amount"])]
    assert got.counts == {"rows": 1, "rejected": 1, "long_rows": 0, "failed": {"qty": 0, "amount": 1}}
    assert "_errors" not in got.data.columns
    # Sentinels stay in the snapshot and are counted.
    spec["on_error"] = "sentinel"
    got = P.process_source(spark, spec, src_time="20240103_000000")
    assert sorted((r.name, r.amount) for r in got.data.collect()) == [("ana", 1.5), ("rui", 0.0)]
    assert got.counts["failed"] == {"qty": 0, "amount": 1} and got.rejected.count() == 0


def test_input_is_parsed_once(spark, monkeypatch):
    """Flags, dictionaries and output read the kept input, not the source."""
    base = work_path(spark, "test-once", unique=True)
    (spark.createDataFrame([("Ana", "1", "1,5")], "name string, qty string, amount string").write.option("header", True)
     .csv(f"{base}/in/src_20240101_000000.csv"))
    spec = _spec(base)
    spec["data_types"]["float_cols"] = "amount"
    spec["mask_data"] = {"references_path": f"{base}/refs", "mask_cols": {"name": "names"}}
    seen = []
    monkeypatch.setattr(P.S, "transform", lambda df, *a, f=P.S.transform, **k: (seen.append(df.inputFiles()), f(df, *a, **k))[1])
    res = P.process_source(spark, spec, src_time="20240102_000000")
    assert seen and all("/side/" in f for files in seen for f in files)
    assert res.data.first().amount == 1.5


def test_freshness_survives_parts_and_reports_errors(spark):
    base = work_path(spark, "test-gate", unique=True)
    (spark.createDataFrame([("Ana", "1")], "name string, qty string").write.option("header", True).csv(f"{base}/in/src_20240101_000000.csv"))
    spec = _spec(base)
    assert P.process_source(spark, spec, now=dt.datetime(2024, 3, 1)).status == "written"
    assert P.process_source(spark, spec, now=dt.datetime(2024, 3, 1), date_part="north").status == "written"
    assert P.process_source(spark, spec, now=dt.datetime(2024, 3, 2)).status == "fresh"
