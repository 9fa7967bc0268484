import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-")})
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
