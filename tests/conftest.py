import pytest

from tripmart import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.create(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "3", "spark.driver.memory": "3g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
