import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyguard.session import build_session  # noqa: E402
from tallyguard.sources import load_transactions  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return load_transactions(spark, SMALL)


@pytest.fixture(scope="session")
def middle(spark):
    return load_transactions(spark, MIDDLE)


def rows(df, *order):
    """Rows as dictionaries, in a fixed order."""
    return [row.asDict() for row in df.orderBy(*(order or ("txn_id",))).collect()]


def assert_close(left, right, tolerance=1e-9):
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert a.keys() == b.keys()
        for name in a:
            if isinstance(a[name], float) and isinstance(b[name], float):
                assert abs(a[name] - b[name]) <= tolerance * max(1.0, abs(b[name])), (name, a, b)
            else:
                assert a[name] == b[name], (name, a, b)
