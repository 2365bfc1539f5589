import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tidewater-tests")
    if os.environ.get("TIDEWATER_STRESS") == "1":
        # many partitions and no AQE coalescing: partitioning mistakes cannot hide
        s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        s.conf.set("spark.sql.shuffle.partitions", "37")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from tidewater.session import shared_dir

    return shared_dir(spark, "test")
