import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quotewright.session import SETTINGS

    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    return SAMPLE


@pytest.fixture(scope="session")
def curated(spark, sample, tmp_path_factory):
    """The curated sample as a stored table."""
    from quotewright.sources import files, sample_tables

    path = str(tmp_path_factory.mktemp("zones") / "curated")
    files.write_curated(sample_tables.curated_from_events(spark, sample), path)
    return files.scan_curated(spark, path)
