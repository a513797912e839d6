"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from tabularium.session import shipped

    shipped(session)
    yield session
    session.stop()
