import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import local_session

    warehouse = tempfile.mkdtemp(prefix="hirelake-warehouse-")
    s = local_session("hirelake-tests", cores="*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse}, scratch=tempfile.mkdtemp(prefix="hirelake-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh scratch folder per test; never cleared by us
    return tempfile.mkdtemp(prefix="hirelake-test-")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, order=None):
    """Collect a small test frame as sorted tuples."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple("" if v is None else str(v) for v in r)) if order is None else out
