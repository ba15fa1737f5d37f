"""One small local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = TOP + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    top = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{top}/shared").config("spark.sql.warehouse.dir", f"{top}/warehouse").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from changeloom.deploy import ship

    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
