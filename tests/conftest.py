import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from folioloom.session import local_session

    session = local_session("tests", cpus=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("no test data here")
    return SMALL
