import pytest

from hitflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("hitflow-tests", "local[8]", shuffle_partitions=4, shared=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
