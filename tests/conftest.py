import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dimforge.session import build_session  # noqa: E402

SMALL_SF = os.environ.get("DIMFORGE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session("local[4]", 8, extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF


def rows(df, cols=None):
    """Order-insensitive multiset of rows (lists -> tuples)."""
    def norm(v):
        if isinstance(v, list):
            return tuple(norm(x) for x in v)
        if hasattr(v, "asDict"):
            return tuple(norm(x) for x in v)
        return v
    cols = cols or df.columns
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
