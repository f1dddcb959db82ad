import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import pytest

from corpuslake.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "4", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
