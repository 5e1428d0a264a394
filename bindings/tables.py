"""Roles of the star-schema columns: batches are ship years, the target is the extended price.

Years up to 1998 train the baseline (one order in five validates it). Later years are batches with
three situations built in: 1999 is healthy, 2000 has its target scaled by 100, and 2001 has its
quantities scaled by 1000 and no target.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.baseline import Baseline, build_baseline
from tidewatch.session import shared_dir
from tidewatch.spec import Derivations, FeatureSpec

NOW = datetime(2024, 5, 1, 12, 0, 0)
MODEL = "price-model"
N_FEATURES = 6

SPEC = FeatureSpec(
    numeric=("l_quantity", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
    target="price",
    ranges={"l_quantity": (1.0, 50.0), "l_discount": (0.0, 0.1), "l_tax": (0.0, 0.08)},
    levels={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")},
    target_range=(900.0, 105_000.0),
    edge_digits=6,
    derived=Derivations(
        interactions=(("quantity_returned", "l_quantity", "l_returnflag", "R"),
                      ("tax_open", "l_tax", "l_linestatus", "O")),
        squares=(("quantity_squared", "l_quantity"), ("discount_squared", "l_discount")),
        flags=(("large_order", "l_quantity", 30.0), ("high_discount", "l_discount", 0.05)),
    ),
)

RULES = {
    "features": {"l_quantity": {"psi_warn": 0.05, "psi_alert": 0.15}, "l_discount": {"psi_warn": 0.2, "psi_alert": 0.4},
                 "l_returnflag": {"psi_alert": 0.5, "note": 1, "r2_warn_drop": "x"}},
    "batches": {
        "2000": {"schema_alert_pct": 99.5, "psi_warn": 0.2, "psi_alert": 0.4},
        "2001": {"psi_warn": 0.05, "psi_alert": 0.15, "features": {"l_tax": {"psi_warn": 0.2}}},
        "1999": 5,
    },
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _predicted() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


# on the stored column, so that the Parquet scan can skip row groups
TRAINING_YEARS = "l_shipdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'"
BATCH_YEARS = "l_shipdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'"


def lineitem(spark: SparkSession, sf: str, years: str = "true") -> DataFrame:
    return table(spark, sf, "lineitem").where(years).select(
        F.year("l_shipdate").alias("yr"), "l_orderkey", "l_linenumber", *SPEC.features,
        F.col("l_extendedprice").alias("price"), _predicted().alias("prediction"))


def training(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = lineitem(spark, sf, TRAINING_YEARS)
    return rows.where("l_orderkey % 5 <> 0"), rows.where("l_orderkey % 5 = 0")


def batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = lineitem(spark, sf, BATCH_YEARS)
    return rows.withColumns({
        "batch_id": F.col("yr").cast("string"),
        "l_quantity": F.when(F.col("yr") == 2001, F.col("l_quantity") * 1000).otherwise(F.col("l_quantity")),
        "price": F.when(F.col("yr") == 2000, F.col("price") * 100).when(F.col("yr") != 2001, F.col("price")),
    })


def delivered(rows: DataFrame) -> DataFrame:
    """(batch_id, has_target, n_features, n_target) as the file listing would give it."""
    sizes = rows.groupBy("batch_id").agg(F.count("*").alias("n_features"), F.count("price").alias("n_values"))
    has_target = F.col("n_values") > 0
    return sizes.select("batch_id", has_target.alias("has_target"), "n_features",
                        F.when(has_target, F.col("n_features")).alias("n_target"))


def baseline(spark: SparkSession, sf: str) -> Baseline:
    """The baseline as scoring reads it: built once, then loaded from its tables."""
    from tidewatch.sources.tables import load_baseline, save_baseline

    train, validation = training(spark, sf)
    path = f"{shared_dir(spark)}/baseline-{uuid4().hex}"
    save_baseline(build_baseline(train, validation, SPEC, MODEL, NOW, N_FEATURES), path)
    return load_baseline(spark, path)


def run_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid4().hex}"


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round for comparison; adding zero turns a negative zero positive."""
    return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in digits.items()})
