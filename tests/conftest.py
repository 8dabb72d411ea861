import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ontime.session import session_builder  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ontime-tests-")
    session = session_builder("local[4]", app_name="ontime-tests", options={
        "spark.sql.shuffle.partitions": "4",
        "spark.local.dir": scratch,
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    }).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
