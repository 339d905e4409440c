import pytest

from beaconry.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
