import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.session import job_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = job_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__showConsoleProgress="false",
        spark__sql__streaming__stateStore__providerClass=
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
