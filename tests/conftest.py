import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ticklake.session import checkpoint_root, get_session
    s = get_session("local[4]", **{"spark.sql.shuffle.partitions": "8",
                                   "spark.sql.execution.arrow.pyspark.enabled": "true"})
    checkpoint_root(s)  # the session's spark.checkpoint.dir, or a fresh folder when unset
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ticklake-test-")


def rows(df, order=None):
    """Collect a (small, test-only) result as sorted dicts."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[k] is None, d[k]) for k in order))
    return out
