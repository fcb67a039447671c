"""Plan checks: registered queries build, have matching oracles, keep Python
out of the plan, and push filters/projections to the scan."""
import __spark_entry__ as E
import sparkprep.queries as Q


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 60
    assert set(o) <= set(q)


def test_no_python_udfs(spark, sf_dir):
    skip = {"mask_dictionary", "process_source", "read_delimited", "raw_lines", "drop_unnamed"}  # run jobs of their own
    for name, fn in Q.queries().items():
        if name in skip:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_pruning_and_pushdown(spark, sf_dir):
    plan = E.queries()["look_back_days"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["n__cliente", "nome", "imposto", "quantidade", "segmento", "data_registo", "saldo"]
