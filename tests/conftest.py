import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    """The rows of a frame in an order of their own; NULLs are no hindrance."""
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="hirelake-test-ckpt-")
    s = build_session("local[4]", "hirelake-tests", {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.checkpoint.dir": ckpt,
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="hirelake-test-")
