import pytest

from .session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
