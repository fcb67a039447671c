import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("SPARKPREP_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]")
               .appName("sparkprep-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    # tests only: a private shared folder when the cluster sets none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sparkprep-test-"))
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *cols):
    """Collect selected columns as a list of tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
