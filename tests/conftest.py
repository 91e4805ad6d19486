import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from boardwalk.session import build_session

    s = build_session(
        "local[4]",
        4,
        app="boardwalk-tests",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only when the environment has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="boardwalk-tests-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


def rows(df, order=None):
    """Collected rows as sorted tuples (None sorts first)."""
    cols = order or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: [(x is not None, x) for x in t])
