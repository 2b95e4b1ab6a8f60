import pytest

from cardwatch.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def view(spark):
    from cardwatch.sources.tables import transactions

    return transactions(spark, SMALL).cache()
