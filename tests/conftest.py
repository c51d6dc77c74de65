import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakelayer.session import build_session
    s = build_session("local[4]", app="lakelayer-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from lakelayer.session import scratch_dir
    return lambda label="t": scratch_dir(spark, label)
