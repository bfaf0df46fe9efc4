import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.evenhand.spread", "8")
               .config("spark.driver.memory", "4g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A table of texts from plain strings, doc_id counted from 0."""
    def build(*values, **columns):
        rows = [(n, v) for n, v in enumerate(values)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        from pyspark.sql import functions as F

        for name, value in columns.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return build


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
