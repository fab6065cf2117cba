import os
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from lodestrata.session import local_session

    return local_session(4, 4, "3g")


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
