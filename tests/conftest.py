from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from trunkline.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "trunkline-tests",
        4,
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
