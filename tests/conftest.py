import pytest

from paddock.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("paddock-tests", cores=8, **{"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()
