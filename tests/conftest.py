import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall.settings import SPARK_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("footfall-tests")
    scratch = tempfile.mkdtemp(prefix="footfall-tests-")
    settings = {
        **SPARK_CONF,
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "America/New_York",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def sketched(monkeypatch):
    """Hot keys are looked for however few rows there are."""
    from footfall.operators import lookup

    monkeypatch.setattr(lookup, "LEAST_BYTES", 0)
