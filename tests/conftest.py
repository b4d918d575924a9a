import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skuflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def pipe(spark):
    from skuflow.plans.pipeline import Pipeline
    return Pipeline.from_testdata(spark, SF_SMALL, forecaster="moving_average")
