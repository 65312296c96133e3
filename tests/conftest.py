import os

import pytest

from clearbook.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session("clearbook-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def ledger(spark, sf_dir):
    from clearbook.sources.derived import derived_ledger

    return derived_ledger(spark, sf_dir)
