from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quorumtext.session import get_session

    session = get_session(4, spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('checkpoint')}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
