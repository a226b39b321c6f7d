import pytest

from tests.compare import oracle, session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def con():
    return oracle(SF)


@pytest.fixture(scope="session")
def sf():
    return SF
