import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldseam.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    quiet["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("shared"))
    session = create_session("tests", "local[4]", 4, quiet)
    yield session
    session.stop()


@pytest.fixture(params=["plain", "chunked"])
def plan(request, spark):
    """Run a test with plain windows and with every group treated as too large."""
    name = "goldseam.maxGroupRows"
    if request.param == "chunked":
        spark.conf.set(name, "0")
    yield request.param
    spark.conf.unset(name)
