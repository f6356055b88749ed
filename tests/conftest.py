import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tarmac.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tarmac-warehouse-"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tarmac-checkpoint-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
