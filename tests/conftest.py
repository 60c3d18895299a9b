import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def runs_of_three(spark):
    """Three runs of one job; their step echoes a tag."""
    from runsift.schemas import RUNS

    rows = [
        ("project1", n, f"#{n}", None, f"+ echo tag-project1-{n}\ntag-project1-{n}\n", f"job/project1/{n}/")
        for n in (1, 2, 3)
    ]
    return spark.createDataFrame(rows, RUNS)


@pytest.fixture(scope="session")
def three_jobs(spark):
    from runsift.schemas import JOBS

    return spark.createDataFrame([(f"project{i}", f"project{i}", None) for i in (1, 2, 3)], JOBS)
