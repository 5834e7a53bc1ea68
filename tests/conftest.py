import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from skein.session import local_session

    s = local_session("*", 8, app="skein-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
