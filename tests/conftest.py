import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarry.session import build_session
    from tools.plan_summary import EVENT_LOG

    # the checkpoint folder comes from the session (spark.checkpoint.dir);
    # build_session only creates a temporary one in local mode when it is unset
    # the event log tells tests which plans really ran
    s = build_session(master="local[4]", shuffle_partitions=4, extra=EVENT_LOG | {
        "spark.driver.memory": "4g", "spark.eventLog.dir": f"file://{tmp_path_factory.mktemp('events')}"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
