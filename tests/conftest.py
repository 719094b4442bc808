import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickstats.session import local_session
    # A non-UTC session zone on purpose: no result may depend on it.
    s = local_session(4, 4, app="clickstats-tests",
                      extra={"spark.sql.session.timeZone": "America/New_York"})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="clickstats-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def lines_df(spark, lines, **extra_cols):
    """A one-column ``value`` DataFrame (plus constant extra columns)."""
    rows = [(v, *extra_cols.values()) for v in lines]
    schema = "value string" + "".join(f", {k} bigint" for k in extra_cols)
    return spark.createDataFrame(rows, schema)
