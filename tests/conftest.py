import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lifetab.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def bucketed(spark):
    """Force the bucketed (cluster-scale) paths of the ordered helpers."""
    old = spark.conf.get("lifetab.ordered.smallRows", "100000")
    spark.conf.set("lifetab.ordered.smallRows", "0")
    yield
    spark.conf.set("lifetab.ordered.smallRows", old)


SF = os.environ.get("LIFETAB_TEST_SF", "/root/testdata/sf0.001")
