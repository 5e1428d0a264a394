"""Comparing candidate model families, over a table of candidates.

A candidates table has one row per (comparison, family), with its catalogue position and metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("rmse", "mae", "r2", "mape", "rmse_log", "mae_log", "r2_log", "mape_log", "adj_r2", "n_samples")
OVERFITTING = "overfitting_r2_diff"


def selection_column(df: DataFrame, metric: str) -> Column:
    """The column compared by; an unknown name fails instead of choosing by something else."""
    prefix, _, name = metric.partition("_")
    if metric != OVERFITTING and not (prefix in ("val", "train") and name in METRICS):
        raise KeyError(f"selection metric {metric!r} is neither val_*, train_* nor {OVERFITTING}")
    if metric not in df.columns:
        raise KeyError(f"selection metric {metric!r} is not in the candidates table")
    return F.col(metric)


def _order(value: Column, mode: str) -> Column:
    if mode not in ("min", "max"):
        raise ValueError(f"mode must be min or max, not {mode!r}")
    return value.desc_nulls_last() if mode == "max" else value.asc_nulls_last()


def with_overfitting(df: DataFrame) -> DataFrame:
    """Gap between training and validation r2, and its band."""
    gap = F.col("train_r2") - F.col("val_r2")
    band = (F.when(gap > 0.15, "severe").when(gap > 0.10, "moderate").when(gap > 0.05, "minor").otherwise("none"))
    return df.withColumns({OVERFITTING: gap, "overfitting_band": band})


def rank_candidates(df: DataFrame, groups: Sequence[str], metric: str = "val_rmse", mode: str = "min",
                    keep: int | None = None) -> DataFrame:
    """Position within each comparison; ties go to the family that comes first in the catalogue.

    With `keep` only the best are wanted, and Spark then limits every task's rows before the shuffle.
    """
    value = selection_column(df, metric)
    order = Window.partitionBy(*groups).orderBy(_order(value, mode), F.col("catalog_order"))
    ranked = df.withColumns({"selection_value": value, "position": F.row_number().over(order)})
    return ranked.where(F.col("position") <= keep) if keep else ranked


def select_best(df: DataFrame, groups: Sequence[str], metric: str = "val_rmse", mode: str = "min") -> DataFrame:
    """Winner, runner-up, and whether cross-validation would have chosen another family."""
    top = rank_candidates(df, groups, metric, mode, keep=2)
    chosen = top.groupBy(*groups).agg(
        F.max(F.when(F.col("position") == 1, F.col("family"))).alias("winner"),
        F.max(F.when(F.col("position") == 1, F.col("selection_value"))).alias("winner_value"),
        F.max(F.when(F.col("position") == 2, F.col("family"))).alias("runner_up"),
        F.max(F.when(F.col("position") == 2, F.col("selection_value"))).alias("runner_up_value"))
    by_cv = df.groupBy(*groups).agg(
        F.min_by("family", F.struct(F.col("cv_rmse_log").isNull(), "cv_rmse_log", "catalog_order")).alias("cv_winner"))
    return chosen.join(by_cv, list(groups)).withColumn("rankings_disagree", F.col("winner") != F.col("cv_winner"))


def comparison_table(df: DataFrame, groups: Sequence[str], metric: str = "val_rmse", mode: str = "min",
                     floor_family: str = "elasticnet") -> DataFrame:
    """Candidates in selection order, each with its distance in val_rmse to the linear floor."""
    value = selection_column(df, metric)
    floor = df.where(F.col("family") == floor_family).select(*groups, F.col("val_rmse").alias("_floor"))
    return (
        df.join(floor, list(groups), "left")
        .withColumns({"selection_value": value, "delta_to_linear": F.col("_floor") - F.col("val_rmse")})
        .drop("_floor").orderBy(*groups, _order(F.col("selection_value"), mode))
    )


def top_trials(trials: DataFrame, n: int = 5, family: str = "family", score: str = "mean_test_rmse") -> DataFrame:
    """The n best-ranked search trials of each family; equal scores share a rank.

    Cut by row like a list, so ties at the end are settled by trial number.
    """
    by_score = Window.partitionBy(family).orderBy(F.col(score).asc_nulls_last())
    by_row = Window.partitionBy(family).orderBy(F.col(score).asc_nulls_last(), "trial")
    kept = trials.withColumn("_at", F.row_number().over(by_row)).where(F.col("_at") <= n)
    # every better trial is kept too, so ranking what was kept gives the rank among all
    return kept.withColumn("rank", F.rank().over(by_score)).drop("_at")
