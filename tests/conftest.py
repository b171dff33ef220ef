import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tubetrace.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 2, {"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("FATAL")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()
