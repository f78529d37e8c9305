import pytest

from foliant.session import make_session


@pytest.fixture(scope="session")
def spark():
    s = make_session("tests", 4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
