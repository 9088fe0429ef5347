import pytest

from siltworks.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", partitions=4, memory="6g")
    yield s
    s.stop()
