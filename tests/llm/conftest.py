import pytest

from effort_analytics.session import get_spark


@pytest.fixture(scope="session")
def spark():
    return get_spark("local[4]", 4)
