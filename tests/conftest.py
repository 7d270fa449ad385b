import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terroir.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="terroir-wh-")
    s = build_session("local[4]", app="terroir-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh,
                             "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="terroir-t-")
