import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from torqueframe.session import ensure_checkpoint_dir, get_session
    s = get_session("local[4]", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
