import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session

    ckpt = tempfile.mkdtemp(prefix="quayside-test-ckpt-")
    s = build_session("local[4]", app_name="quayside-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": ckpt,
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_base(spark):
    from quayside.session import scratch_path

    return scratch_path(spark, "t")


SMOKE_DIR = "/root/testdata/sf0.001"
