"""The snapshot every batch is compared with, as four long tables keyed by model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import FeatureSpec
from .metrics import canonical_metrics
from .profile import category_frequencies, profile_and_bins, reference_series
from .shaping import to_series


@dataclass(frozen=True)
class Baseline:
    profile: DataFrame   # model_id, series, n, mean, std, min, max, p01..p99
    bins: DataFrame      # model_id, series, edges, freqs
    freqs: DataFrame     # model_id, feature, category, freq
    metrics: DataFrame   # model_id, metric, value

    def for_model(self, model_id: str) -> "Baseline":
        return Baseline(*[t.where(F.col("model_id") == model_id)
                          for t in (self.profile, self.bins, self.freqs, self.metrics)])


def metric_rows(metrics: DataFrame, prefix: str = "val_") -> DataFrame:
    """One wide metrics row as (metric, value) rows."""
    names = [c for c in metrics.columns if c not in ("model_id",)]
    long = metrics.select(*[F.col(c).cast("double").alias(f"{prefix}{c}") for c in names])
    return long.unpivot([], [f"{prefix}{c}" for c in names], "metric", "value")


def build_baseline(train: DataFrame, validation: DataFrame, spec: FeatureSpec, model_id: str, at,
                   n_features: int | None = None, accuracy: int = 10_000) -> Baseline:
    """Profiles and bins of the training split and of the validation predictions; validation metrics."""
    series = reference_series(train, validation, spec)
    model, created = F.lit(model_id).alias("model_id"), F.lit(at).cast("timestamp_ntz").alias("created_at")

    profile, bins = profile_and_bins(series, spec.bins, spec.edge_digits, accuracy)
    levels = to_series(train, [], spec.categorical, "feature", "value", "string")
    freqs = category_frequencies(levels).select("feature", "category", "freq")
    metrics = metric_rows(canonical_metrics(validation, [], spec.target, spec.prediction, n_features))
    return Baseline(
        profile.select(model, created, "*"),
        bins.select(model, created, "*"),
        freqs.select(model, created, "*"),
        metrics.select(model, created, "*"),
    )
