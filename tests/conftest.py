import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortmill.session import build_session, send_package_by_value  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    send_package_by_value()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
