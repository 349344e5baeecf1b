import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from corpusloom.session import build, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="3g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
