import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import session, ship

    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
