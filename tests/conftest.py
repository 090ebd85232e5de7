import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from finlake.session import get_session
    ckpt = tempfile.mkdtemp(prefix="finlake-test-ckpt-")
    s = get_session("local[4]", app_name="finlake-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": f"{ckpt}/warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_table(tmp_path):
    return str(tmp_path / "table")
