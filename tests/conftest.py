"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_point  # noqa: E402
from tripforge.session import SETTINGS  # noqa: E402
from tripforge.work import clean_up  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[4]").appName("tests")
    shared = tmp_path_factory.mktemp("shared")
    conf = SETTINGS | {"spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(shared)}
    for k, v in conf.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    entry_point._importable(s)
    yield s
    clean_up(s)
    assert not [p for p in shared.iterdir() if p.name.startswith("tripforge-")]
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
