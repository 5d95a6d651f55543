from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kerbside.config import local_session

    scratch = tempfile.mkdtemp(prefix="kerbside-test-")
    s = local_session("kerbside-tests", "*", 8, scratch=scratch)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="kerbside-case-")
