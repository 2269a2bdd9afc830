"""Every registered query against its SQL counterpart at the smallest scale."""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

import __spark_entry__ as registry
from tideline.plans.oracles import oracles
from tideline.plans.queries import registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registered()) == set(oracles())
    assert set(registered()) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, registered()[name], oracles()[name], FOLDER) is None


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.columns == ["window_start", "window_end", "pv", "uv"]
