import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("strata-tests", cpus="8", memory="6g")
    yield session
    session.stop()
