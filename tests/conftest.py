import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from reportlake.session import configure

    s = (SparkSession.builder.master("local[4]").appName("reportlake-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rl-test-ckpt-"))  # tests only
    configure(s)
    yield s


@pytest.fixture()
def workdir(spark):
    from reportlake.session import scratch_dir

    return scratch_dir(spark, "test").replace("file:", "")


@pytest.fixture()
def lake(spark):
    import uuid

    from reportlake.plans.lake import Lake

    return Lake(spark, "t_" + uuid.uuid4().hex[:8])


def plan_text(df) -> str:
    """The physical plan as ``explain()`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
