import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shopfloor.session import build_session

    s = build_session(
        "local[4]",
        app_name="shopfloor-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shopfloor-test-ckpt-"),
            "spark.sql.autoBroadcastJoinThreshold": "10MB",
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shopfloor-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (of ``cols`` or all columns)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(repr, t)))
