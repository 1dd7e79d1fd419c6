from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    top = tmp_path_factory.mktemp("spark")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.warehouse.dir": str(top / "warehouse"), "spark.driver.extraJavaOptions": f"-Dderby.system.home={top}", "spark.driver.memory": "4g"}
    made = SparkSession.builder.master("local[*]").config(map=conf).getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
