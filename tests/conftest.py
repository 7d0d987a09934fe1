import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabula.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tabula-wh-")
    s = build_session(
        "local[4]",
        app="tabula-tests",
        conf={"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": warehouse},
    )
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tabula-test-")
