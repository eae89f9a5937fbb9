import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayside.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        "wayside-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="10000",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
