import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from millrace import session

    shared = tempfile.mkdtemp(prefix="millrace-tests-")
    s = session.build("tests", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                      spark__sql__shuffle__partitions="4",
                      spark__driver__memory="8g", spark__checkpoint__dir=shared)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def lake(tmp_path):
    from millrace.sources.tables import Lake

    return Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sf():
    return SF
