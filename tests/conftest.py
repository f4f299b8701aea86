import pytest

from flowline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "flowline-tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, None first."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=lambda t: [(v is not None, v) for v in t])

    return collect
