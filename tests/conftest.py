import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cellstrand.session import session

    folder = tmp_path_factory.mktemp("spark")
    own = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.driver.memory": "3g"})
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF
