import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cellfold.session import local_session
    session = local_session(cores="*", shuffle_partitions=8, app="cellfold-tests")
    yield session


@pytest.fixture()
def scratch(spark):
    from cellfold.session import scratch_path
    return lambda tag="t": scratch_path(spark, tag)


def same_rows(a, b):
    """Multiset equality of two frames with equal schemas, inside Spark."""
    from cellfold.operators.audit import comparable
    a, b = comparable(a), comparable(b)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
