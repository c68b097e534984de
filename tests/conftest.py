import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from foliospark.runtime import local_session

    s = local_session("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
