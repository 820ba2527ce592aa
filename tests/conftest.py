from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rostrum.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", cpus=4, **{"spark.sql.shuffle.partitions": "4"})
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """A DataFrame's rows as sorted tuples."""

    def get(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return get
