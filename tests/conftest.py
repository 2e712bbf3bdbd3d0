import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetcast.session import ensure_checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8, app="fleetcast-tests")
    ensure_checkpoint_dir(s)
    yield s
