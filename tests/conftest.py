import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewatch.session import build_session  # noqa: E402

NOW = datetime(2024, 5, 1, 12, 0, 0)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def people(spark, n, seed, age_shift=0, bmi_factor=1.0):
    """Insurance-like rows from seeded random columns."""
    rows = spark.range(n).select(
        (F.floor(F.rand(seed) * 46) + 18 + age_shift).cast("double").alias("age"),
        F.when(F.rand(seed + 1) < 0.5, "male").otherwise("female").alias("sex"),
        (F.round(F.least(F.greatest(F.randn(seed + 2) * 6 + 30, F.lit(15.0)), F.lit(55.0)), 3) * bmi_factor).alias("bmi"),
        F.floor(F.rand(seed + 3) * 4).cast("double").alias("children"),
        F.when(F.rand(seed + 4) < 0.2, "yes").otherwise("no").alias("smoker"),
        F.element_at(F.array(*[F.lit(r) for r in ("northeast", "northwest", "southeast", "southwest")]),
                     F.floor(F.rand(seed + 5) * 4).cast("int") + 1).alias("region"),
        F.col("id").alias("row_index"))
    return rows.withColumn("charges", 200 * F.col("age") + F.when(F.col("smoker") == "yes", 20000).otherwise(0)
                           + 50 * F.col("children") + 1000)
