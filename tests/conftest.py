import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("churnspark-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="churnspark-test-ckpt-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="churnspark-test-")


#: Queries that train 300 trees, some of them several times: minutes each.  Their
#: results are compared with the SQL by tools/oracle_check.py.
FULL_SIZE = {"ensemble_vote", "ensemble_stack", "batch_score", "job_manual", "job_retrain", "job_search"}


def pytest_collection_modifyitems(items):
    if os.environ.get("CHURNSPARK_FULL_SIZE"):
        return
    for item in items:
        if item.name.removeprefix("test_oracle[").removesuffix("]") in FULL_SIZE:
            item.add_marker(pytest.mark.skip(reason="trains full-size models; set CHURNSPARK_FULL_SIZE=1"))
