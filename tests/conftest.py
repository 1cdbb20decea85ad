"""Shared fixtures: one local session for the whole test run."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowspark.session import build_session
    s = build_session("flowspark-tests", cpus="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_shared(spark):
    from flowspark.session import scratch_path
    return scratch_path(spark, "test")
