from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def folder():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("given tables are not here")
    return path
