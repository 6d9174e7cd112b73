from __future__ import annotations

import os
import sys
import tempfile
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    # Tests run locally, where no shared checkpoint directory is configured;
    # a fresh scratch directory stands in for it.
    ckpt = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    s = build_session("local[4]", app_name="tessera-tests", shuffle_partitions=4, checkpoint_dir=ckpt)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small_tables(spark):
    from tessera.sources.fixtures import fixture_frames

    return fixture_frames(spark, SF_SMALL)


@contextmanager
def settings(spark, conf):
    """Run-time settings for a while."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")
