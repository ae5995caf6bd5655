import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark
    import tempfile
    s = get_spark("local[4]", shuffle_partitions=4, app_name="strata-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
