import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rainledger.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = configure(builder).getOrCreate()
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate an expression builder over single-column rows."""

    def evaluate(kind, inputs, build):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(build("v")).collect()]

    return evaluate
