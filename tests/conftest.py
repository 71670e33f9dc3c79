import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tieout.plans.session import local_session

    s = local_session("*", 8, app="tieout-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ledger(spark):
    from tieout.plans.ledger import fixture_ledger

    return fixture_ledger(spark, SF_SMALL)
