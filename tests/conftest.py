import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from healthmart.session import build_session
    warehouse = tempfile.mkdtemp(prefix="healthmart-warehouse-")
    s = build_session("local[4]", 4, app_name="healthmart-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (for small fixtures only)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
