import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meridian.session import get_session
    s = get_session("local[4]", app="meridian-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive asserts)."""
    cols = cols or df.columns
    return sorted(tuple(r) for r in df.select(*cols).collect())
