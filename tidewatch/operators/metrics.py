"""Regression metrics per group, in the target's scale and in log scale, from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import finite, nan_to_null


def _metric_aggregates(actual: Column, predicted: Column, suffix: str = "") -> list[Column]:
    error = actual - predicted
    squared = F.sum(error * error)
    count = F.count(error)
    spread = count * F.var_pop(actual)
    flat = F.min(actual) == F.max(actual)
    r2 = F.when(count > 1, F.when(flat, F.when(squared == 0, 1.0).otherwise(0.0))
                .otherwise(1 - F.try_divide(squared, spread)))
    return [
        F.sqrt(F.avg(error * error)).alias(f"rmse{suffix}"),
        F.avg(F.abs(error)).alias(f"mae{suffix}"),
        r2.alias(f"r2{suffix}"),
        (F.avg(F.abs(F.try_divide(error, actual))) * 100).alias(f"mape{suffix}"),
    ]


def adjusted_r2(r2: Column, n: Column, n_features: Column) -> Column:
    freedom = n - n_features - 1
    return F.when((n_features > 0) & (freedom > 0), 1 - (1 - r2) * (n - 1) / freedom)


def canonical_aggregates(actual: str, predicted: str) -> tuple[Column, list[Column]]:
    """(row expression, aggregates over it): what `canonical_metrics` computes in its one pass."""
    both = finite(F.col(actual).cast("double")).isNotNull() & finite(F.col(predicted).cast("double")).isNotNull()

    def in_log(value: Column) -> Column:
        return F.log1p(F.greatest(value.cast("double"), F.lit(0.0)))

    pair = F.when(both, F.struct(
        F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p"),
        in_log(F.col(actual)).alias("ly"), in_log(F.col(predicted)).alias("lp")))
    value = F.col("_pair")
    return pair.alias("_pair"), [
        F.count(value["y"]).alias("n_samples"),
        *_metric_aggregates(value["y"], value["p"]),
        *_metric_aggregates(value["ly"], value["lp"], "_log"),
    ]


def canonical_metrics(df: DataFrame, keys: Sequence[str], actual: str, predicted: str,
                      n_features: int | None = None) -> DataFrame:
    """rmse, mae, r2, mape in both scales, adjusted r2 and n, over rows finite on both sides.

    r2 is 1 - SSE/SST (not a squared correlation), null for a single row, and 1 or 0 for a
    constant target. MAPE skips zero actuals.
    """
    pair, aggregates = canonical_aggregates(actual, predicted)
    out = df.select(*keys, pair).groupBy(*keys).agg(*aggregates)
    return out.withColumn("adj_r2", adjusted_r2(F.col("r2"), F.col("n_samples"), F.lit(n_features).cast("int")))


def summary_aggregates(predicted: str) -> list[Column]:
    value = nan_to_null(F.col(predicted))
    return [F.avg(value).alias("pred_mean"), F.stddev_pop(value).alias("pred_std"),
            F.min(value).alias("pred_min"), F.max(value).alias("pred_max")]


def prediction_summary(df: DataFrame, keys: Sequence[str], predicted: str) -> DataFrame:
    """Mean, population deviation and extremes of the predictions."""
    return df.groupBy(*keys).agg(*summary_aggregates(predicted))


def batch_facts(df: DataFrame, actual: str, predicted: str, n_features: int | None = None) -> DataFrame:
    """Row count, metrics and prediction summary of every batch, from one pass."""
    pair, aggregates = canonical_aggregates(actual, predicted)
    out = df.select("batch_id", predicted, pair).groupBy("batch_id").agg(
        F.count("*").alias("n_rows"), *aggregates, *summary_aggregates(predicted))
    return out.withColumn("adj_r2", adjusted_r2(F.col("r2"), F.col("n_samples"), F.lit(n_features).cast("int")))
