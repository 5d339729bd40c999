import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lectern.session import local_session
    s = local_session(4, 8)
    yield s
    s.stop()


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples (of ``cols`` when given)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
