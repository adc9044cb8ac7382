import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lakework.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="lakework-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the selected columns (order-insensitive compare)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
