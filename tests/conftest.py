import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from drivelake.session import local_session
    s = local_session("4", shuffle_partitions=4, app="drivelake-tests", checkpoint=tempfile.mkdtemp(prefix="drivelake-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="drivelake-test-")
