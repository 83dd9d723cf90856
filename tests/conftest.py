import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def blobs(spark):
    """Points in three groups of different density, some noise, and many copies of one point."""
    import numpy as np

    rng = np.random.default_rng(7)
    x = np.vstack([
        rng.normal([0, 0, 0], 0.3, (60, 3)), rng.normal([4, 0, 1], 0.5, (50, 3)),
        rng.normal([0, 5, -2], 0.4, (40, 3)), rng.uniform(-8, 8, (20, 3)),
        np.repeat([[2.0, 2.0, 2.0]], 12, axis=0),
    ])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    return x, df
