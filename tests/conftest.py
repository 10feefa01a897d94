import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


MSG_SCHEMA = ("message_id BIGINT, operation STRING, schema STRING, table STRING, ts_ns BIGINT, before STRING,"
              " after STRING, key_id BIGINT, event_time BIGINT")
