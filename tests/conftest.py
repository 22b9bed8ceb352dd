from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyworks.plans.session import tune
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages")))
               .config("spark.ui.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()
