import pytest

from estrato.session import ship_package


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)
