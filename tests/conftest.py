import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from hazardloom.plans.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    return s
