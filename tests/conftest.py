import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexigraft.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    return d
