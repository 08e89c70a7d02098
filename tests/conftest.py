import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over literal texts: one(text, expression) -> values."""
    from pyspark.sql import functions as F

    def run(rows, schema, *columns):
        df = spark.createDataFrame(rows, schema)
        return [tuple(r) for r in df.select(*(F.expr(c) if isinstance(c, str) else c for c in columns)).collect()]

    return run
