import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkmine.session import get_session

    s = get_session("local[4]", 8)
    yield s
    s.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
