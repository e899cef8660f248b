import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    s = (SparkSession.builder.master("local[*]").appName("strata-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")


def rows(df, order=None):
    cols = order or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()],
                  key=lambda t: tuple((x is None, str(x)) for x in t))
