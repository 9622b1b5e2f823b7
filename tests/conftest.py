import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tidemerge.session import local_session

    folder = tempfile.mkdtemp(prefix="tidemerge-tests-")
    # the files of the given tables are small: few partitions keep the many small jobs quick
    return local_session("8", 4, **{"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": folder})


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"
