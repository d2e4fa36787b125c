import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lauter.session import build  # noqa: E402
from lauter.sinks import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build(
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(shared))
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


@pytest.fixture
def column(spark):
    """Evaluate a column function over a list of values."""

    def run(function, values, kind="string"):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = frame.select("i", function(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
