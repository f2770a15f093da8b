import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskframe.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="riskframe-tests", shuffle_partitions=4)
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="rf-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="rf-test-")
