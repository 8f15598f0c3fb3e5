import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sortproof.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="sortproof-tests")
    yield s


@pytest.fixture()
def out_dir(tmp_path):
    # tests only: a fresh local folder per test
    return str(tmp_path / "out")
