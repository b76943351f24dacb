import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-"),
        "spark.local.dir": tempfile.mkdtemp(prefix="tessera-test-local-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_sf():
    if not os.path.exists(SMALL_SF):
        pytest.skip("driver test tables not present")
    return SMALL_SF


def rows(df, *cols):
    """Collect selected columns as sorted tuples (order-insensitive compare)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
