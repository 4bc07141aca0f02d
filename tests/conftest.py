import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    from seqloom import local_session
    from seqloom.session import ship_package

    session = local_session("8", 8, spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session
