import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0 = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import checkpoint_root, get_spark

    s = get_spark("local[4]", app="quarry-tests", shuffle_partitions=4)
    checkpoint_root(s)  # a private folder only when the session names none
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
