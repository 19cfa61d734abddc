import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tabprep.session import get_session

    s = get_session("tests", 8)
    s.sparkContext.setLogLevel("OFF")
    return s
