"""Snapshots: FIXTURES A8-A10 and A12; writer idempotence."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkprep.session import work_path
from sparkprep.sources import snapshots as SN

TAGS = ["20240101_000000", "20240215_120000", "20240301_000000"]


@pytest.fixture(scope="module")
def root(spark):
    r = work_path(spark, "test-snapshots", unique=True)
    for i, t in enumerate(TAGS):
        SN.write_snapshot(spark.range(3).withColumn("v", F.lit(i)), r, "src", t)
    return SN.snapshot_path(r, "src")


def _one(df):
    return {r.snapshot for r in df.select("snapshot").distinct().collect()}


def test_latest(spark, root):
    assert _one(SN.read_latest(spark, root)) == {TAGS[2]}


def test_on_date(spark, root):
    assert _one(SN.read_on_date(spark, root, "20240215")) == {TAGS[1]}


def test_as_of(spark, root):
    assert _one(SN.read_as_of(spark, root, "20240220_000000")) == {TAGS[1]}
    assert _one(SN.read_as_of(spark, root, "20240215_120000")) == {TAGS[1]}
    assert _one(SN.read_as_of(spark, root, "20240215_120000", inclusive=False)) == {TAGS[0]}
    with pytest.raises(Exception):
        SN.read_as_of(spark, root, "20230101_000000").collect()


def test_list_and_rewrite_idempotent(spark, root):
    base = root.rsplit("/", 2)[0]
    SN.write_snapshot(spark.range(3).withColumn("v", F.lit(9)), base, "src", TAGS[0])
    assert sorted(r.snapshot for r in SN.list_snapshots(spark, root).collect()) == TAGS
    again = SN.read_snapshots(spark, root).where(F.col("snapshot") == TAGS[0])
    assert sorted(r.v for r in again.collect()) == [9, 9, 9]


def test_bad_tag(spark):
    with pytest.raises(ValueError):
        SN.validate_tag("2024-01-01")


def test_stale_sources(spark):
    now = dt.datetime(2024, 3, 1)
    df = spark.createDataFrame([("a", dt.datetime(2024, 2, 23), "day", 7), ("b", dt.datetime(2024, 2, 22), "day", 7),
                                ("c", dt.datetime(2024, 2, 29), None, 0),
                                ("d", dt.datetime(2024, 1, 31), "month", 0)],
                               "src string, last_snapshot timestamp, unit string, rate int")
    got = {r.src: r.stale for r in SN.stale_sources(df, now).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": True}


def test_read_named_modes_and_csv(spark):
    r = work_path(spark, "test-named", unique=True)
    for t in TAGS:
        SN.write_snapshot(spark.range(2).withColumn("tag", F.lit(t)), r, "a", t, product="p")
        SN.write_snapshot(spark.range(1).withColumn("tag", F.lit(t)), r, "b", t, product="p", file_type="csv")
    cat = {"src": {"root": r, "product": "p", "tags": ["a"]},
           "csv": {"root": r, "product": "p", "tags": ["b"], "file_type": "csv"}}
    assert _one(SN.read_named(spark, cat, "src")) == {TAGS[2]}
    assert _one(SN.read_named(spark, cat, "src", selection_mode="by_date", filter_date="20240215")) == {TAGS[1]}
    a, b = SN.read_named(spark, {"both": {"root": r, "product": "p", "tags": ["a", "a"]}}, "both")
    assert _one(a) == _one(b) == {TAGS[2]}
    csv_latest = SN.read_named(spark, cat, "csv")
    assert [(r_.id, r_.tag) for r_ in csv_latest.collect()] == [(0, TAGS[2])]  # types are kept
    with pytest.raises(KeyError):
        SN.read_named(spark, cat, "nope")


def test_empty_rerun_replaces_old_rows(spark):
    r = work_path(spark, "test-empty", unique=True)
    SN.write_snapshot(spark.range(3), r, "a", TAGS[0])
    SN.write_snapshot(spark.range(0), r, "a", TAGS[0])
    df = SN.read_latest(spark, SN.snapshot_path(r, "a"))
    assert df.columns == ["id", "snapshot"] and df.count() == 0


def test_lookup_opens_only_the_chosen_folder(spark, root):
    plan = SN.list_snapshots(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    files = SN.read_as_of(spark, root, "20240220_000000").inputFiles()
    assert files and all(f"snapshot={TAGS[1]}/" in f for f in files)


def test_parts_do_not_disturb_the_tag(spark):
    r = work_path(spark, "test-parts", unique=True)
    SN.write_snapshot(spark.range(2), r, "a", TAGS[0])
    SN.write_snapshot(spark.range(5), r, "a", TAGS[1], part="north")
    assert SN.read_latest(spark, SN.snapshot_path(r, "a")).count() == 2
    assert SN.read_snapshots(spark, SN.snapshot_path(r, "a")).count() == 2
    assert SN.read_latest(spark, SN.snapshot_path(r, "a", part="north")).count() == 5


def test_missing_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        SN.read_latest(spark, work_path(spark, "test-none", unique=True))


def _failing(spark):
    """Fails in its last rows, when others have been written."""
    return spark.range(0, 4000, 1, 4).withColumn("v", F.when(F.col("id") == 3999, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("int"))


def test_failed_runs_are_invisible(spark):
    r = work_path(spark, "test-commit", unique=True)
    path = SN.snapshot_path(r, "a")
    with pytest.raises(Exception, match="broken"):
        SN.write_snapshot(_failing(spark), r, "a", TAGS[0])
    assert SN.snapshot_names(spark, path) == [] and not SN.list_folder(spark, f"{path}/{SN.STAGING}")
    with pytest.raises(FileNotFoundError):
        SN.read_latest(spark, path)
    SN.write_snapshot(spark.range(5).withColumn("v", F.lit(7)), r, "a", TAGS[0])
    for tag in TAGS[:2]:  # a re-run, and a first write
        with pytest.raises(Exception, match="broken"):
            SN.write_snapshot(_failing(spark), r, "a", tag)
    with pytest.raises(Exception, match="broken"):
        SN.write_snapshots_by(_failing(spark), path, F.lit(TAGS[2]))
    assert SN.snapshot_names(spark, path) == TAGS[:1]
    assert [tuple(x) for x in SN.read_latest(spark, path).select("id", "v").orderBy("id").collect()] == [(i, 7) for i in range(5)]
    assert SN.commit_of(spark, path, TAGS[0])["figures"] == {"rows": 5, "rejected": 0}


def test_failed_run_leaves_the_gate_open(spark):
    from sparkprep.plans import process as P

    base = work_path(spark, "test-gate", unique=True)
    spark.createDataFrame([("31/02/2020",)], "day string").write.option("header", True).csv(f"{base}/in/src_20240101_000000.csv")
    spec = {"raw_source": {"load_parameters": {"path": f"{base}/in", "file_name": "src"}, "type": {"specifics": "file"}},
            "data_types": {"date_cols": {"cols": "day", "global_format": "%d/%m/%Y"}},
            "processed_source": {"save_parameters": {"path": f"{base}/out", "tag": "src"}}, "conf_file": {"refresh_rate": "day,7"}}
    with pytest.raises(Exception, match="unparsable"):
        P.process_source(spark, spec, now=dt.datetime(2024, 3, 1))
    spec["on_error"] = "quarantine"
    done = P.process_source(spark, spec, now=dt.datetime(2024, 3, 1))
    assert done.status == "written" and done.data.count() == 0 and done.rejected.count() == 1
    assert P.process_source(spark, spec, now=dt.datetime(2024, 3, 2)).status == "fresh"


def test_rejected_rows_and_figures_from_one_write(spark):
    df = spark.range(10).select("id", F.array(F.when(F.col("id") % 3 == 0, F.lit("id"))).alias("why"))
    for kind in ("parquet", "csv", "orc", "json"):
        r = work_path(spark, "test-rejected", unique=True)
        path = SN.write_snapshot(df, r, "a", TAGS[0], file_type=kind, rejected=F.col("why")[0].isNotNull(), reasons="why",
                                 figures={"odd": F.sum(F.col("id") % 2)})
        assert SN.read_latest(spark, path).columns == ["id", "snapshot"]
        assert sorted(x.id for x in SN.read_latest(spark, path).collect()) == [1, 2, 4, 5, 7, 8]
        assert sorted(x.id for x in SN.read_rejected(spark, path, TAGS[0]).collect()) == [0, 3, 6, 9]
        assert SN.commit_of(spark, path, TAGS[0])["figures"] == {"rows": 6, "rejected": 4, "odd": 5}
        assert sorted(x.id for x in SN.read_snapshots(spark, path).collect()) == [1, 2, 4, 5, 7, 8]


def test_text_snapshots_keep_their_types(spark):
    r = work_path(spark, "test-types", unique=True)
    rows = [("007", 1.5, dt.datetime(2024, 1, 2, 3, 4, 5), None), ("1e5", None, None, ""), ('a\n"b', 2.0, None, " x ")]
    schema = "code string, n double, at timestamp, note string"
    path = SN.write_snapshot(spark.createDataFrame(rows, schema), r, "a", TAGS[0], file_type="csv")
    got = SN.read_latest(spark, path).drop("snapshot")
    assert got.dtypes == [("code", "string"), ("n", "double"), ("at", "timestamp"), ("note", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_vacuum_removes_only_what_no_commit_names(spark):
    r = work_path(spark, "test-vacuum", unique=True)
    for n in (1, 2):
        path = SN.write_snapshot(spark.range(n), r, "a", TAGS[0])
    spark.range(1).write.parquet(f"{path}/{SN.STAGING}/left")
    assert SN.vacuum_snapshots(spark, path) == []  # all is young
    gone = SN.vacuum_snapshots(spark, path, older_than_hours=-1)
    assert len(gone) == 2 and f"{SN.STAGING}/left" in gone
    assert SN.read_latest(spark, path).count() == 2 and SN.vacuum_snapshots(spark, path, older_than_hours=-1) == []


def test_folders_of_other_tools_are_adopted_when_finished(spark):
    r = work_path(spark, "test-adopt", unique=True)
    path = SN.write_snapshot(spark.range(3), r, "a", TAGS[2])
    spark.range(5).write.parquet(f"{path}/snapshot={TAGS[0]}")
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/snapshot={TAGS[1]}")
    assert SN.snapshot_names(spark, path) == [TAGS[2]]
    assert SN.adopt_snapshots(spark, path) == [TAGS[0]] and SN.adopt_snapshots(spark, path) == []
    assert SN.read_as_of(spark, path, TAGS[1]).count() == 5
    assert SN.read_snapshots(spark, path).groupBy("snapshot").count().orderBy("snapshot").collect() == [(TAGS[0], 5), (TAGS[2], 3)]
    SN.vacuum_snapshots(spark, path, older_than_hours=-1)
    assert SN.read_as_of(spark, path, TAGS[1]).count() == 5
