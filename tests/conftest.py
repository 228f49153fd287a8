import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir is read from the session; when it is unset, the
    # local-mode fallback in keelson.session makes a fresh folder.
    conf = {"spark.driver.memory": "4g",
            # Tests only: managed tables go to a fresh warehouse folder.
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="keelson-wh-")}
    s = get_session("local[4]", app_name="keelson-tests", shuffle_partitions=8, conf=conf)
    yield s
    s.stop()
