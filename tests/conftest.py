import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexigraph.session import session

    shared = tmp_path_factory.mktemp("shared")
    spark = session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{shared}"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def counted(spark):
    """A column's values as they are, and how many were worked out so far."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(value):
        seen.add(1)
        return value

    return same.asNondeterministic(), lambda: seen.value
