import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.dirname(HERE))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tidemark-tests")
    yield s
    s.stop()
