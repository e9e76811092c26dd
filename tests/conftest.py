import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = os.environ.get("GLEANER_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from gleaner.session import local_session

    return local_session(8)


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip(f"no test tables at {path}")
    return path
