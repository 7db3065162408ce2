import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from qamill.session import local_session

    s = local_session("4", shuffle_partitions=4, app="qamill-tests")
    yield s


@pytest.fixture()
def tmpdir_shared(spark):
    """A fresh folder under the session's checkpoint folder."""
    from qamill.session import scratch_dir

    return scratch_dir(spark, "test").replace("file:", "")
