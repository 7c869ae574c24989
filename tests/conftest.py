from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session

    s = build_session(
        master="local[8]", shuffle_partitions=8, extra={"spark.quire.scan.partitions": "8"}
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from quire.checks import duck_connection

    return duck_connection(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    from quire.checks import duck_connection

    return duck_connection(SF_CHECK)
