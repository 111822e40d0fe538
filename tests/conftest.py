from __future__ import annotations

import pytest

from panelwright.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus="4", partitions=4)


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)
