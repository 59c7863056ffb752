"""One small session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from keelson.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
