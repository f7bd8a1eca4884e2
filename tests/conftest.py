import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python stages import the package on the workers, from whatever folder the tests are started in
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventide.session import get_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_session("local[4]", app_name="eventide-tests", shuffle_partitions=8, checkpoint_dir=ckpt)
    yield s
