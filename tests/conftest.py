import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lumen.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="lumen-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of tuples (sorted unless an order is given)."""
    out = [tuple(r) for r in df.collect()]
    return out if order else sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
