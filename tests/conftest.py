from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL_SF = os.environ.get("DOCKMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from dockmart.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app_name="dockmart-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SMALL_SF


@pytest.fixture(scope="session")
def duck_small(sf_dir):
    from harness import duck

    return duck(sf_dir)


@pytest.fixture()
def scratch() -> str:
    return tempfile.mkdtemp(prefix="dockmart-test-")
