import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seatcast.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
