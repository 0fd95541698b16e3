import pytest

from groundtable.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[2]", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.sql.shuffle.partitions": "3", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
