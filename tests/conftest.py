import pytest

from tidegrid import session


@pytest.fixture(scope="session")
def spark():
    s = session.build("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    session.workers_see(s)
    yield s
    s.stop()
