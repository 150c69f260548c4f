import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collect a small test frame as a sorted list of tuples."""
    cols = cols or df.columns
    key = lambda t: tuple((x is not None, "" if x is None else x) for x in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
