import tempfile

import pytest

from tests.session import make_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="claimlake-warehouse-")
    session = make_session(8, 8, spark__sql__warehouse__dir=warehouse)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
