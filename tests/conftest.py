import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df):
    """Rows of a small DataFrame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def edges(spark):
    def make(text):
        pairs = [tuple(x.split(">")) for x in text.split()]
        return spark.createDataFrame(pairs, "src string, dst string")

    return make
