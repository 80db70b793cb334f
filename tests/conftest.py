import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PATHS = [ROOT, os.path.join(ROOT, "tests")]
sys.path[:0] = PATHS
# Python workers unpickle functions of the test modules by name.
os.environ["PYTHONPATH"] = os.pathsep.join([*PATHS, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from rowloom import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return collect
