from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martwell.session import build_session

    s = build_session(master="local[4]", app="martwell-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def model_small(spark):
    from martwell.plans.warehouse import open_warehouse

    return open_warehouse(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as sorted tuples (bounded test frames only)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
