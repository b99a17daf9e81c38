import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillcast.session import get_session

    # spark.checkpoint.dir comes from the environment when it is set there;
    # get_session only creates a scratch folder when it is unset.
    s = get_session("local[4]", app_name="tillcast-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL
