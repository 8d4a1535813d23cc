import os
import tempfile

import pytest

from tidemill.session import build_session, discard_scratch


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemill-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="spark-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    discard_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
