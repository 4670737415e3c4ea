import pytest

from goldspine.session import build_session


@pytest.fixture(scope="session")
def spark():
    # The tests run many small jobs once, which a full optimizing JIT only slows down.
    return build_session("tests", 8, 4, "-XX:TieredStopAtLevel=1")
