import pytest

from farelane.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def zones(spark):
    rows = [(1, "B1", "Airport", "EWR", 40.0, -74.0), (2, "B2", "Centre", "Yellow", 41.0, -73.0)]
    return spark.createDataFrame(
        rows, "LocationID int, Borough string, zone string, service_zone string, latitude double, longitude double"
    )
