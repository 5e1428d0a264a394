"""All batches of a run against the baseline of the model in use, in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.baseline import Baseline
from ..operators.contract import category_violations, missing_column_violations, numeric_violations, row_count_violations
from ..operators.metrics import batch_facts
from ..operators.report import batch_status
from ..operators.signals import batch_frame, batch_signals, drift_signals, feature_psi, reference_metrics, series_psi
from ..operators.summary import category_summary, numeric_summary, without_missing
from ..session import pinned
from ..spec import FeatureSpec


@dataclass(frozen=True)
class Monitored:
    violations: DataFrame
    signals: DataFrame
    psi: DataFrame
    status: DataFrame
    reference: dict[str, float | None]


def monitor(rows: DataFrame, batches: DataFrame, baseline: Baseline, spec: FeatureSpec, model_id: str,
            rules: dict | None = None, n_features: int | None = None,
            present_columns: DataFrame | None = None) -> Monitored:
    """Score card of every batch.

    `rows` carries batch_id, the features, the target and the prediction, and optionally `scored`
    and `unparsed`. `batches` is (batch_id, has_target, n_features, n_target), one row per batch
    that was delivered, readable or not. `present_columns` is (batch_id, column) from the headers.
    The rows are read three times, each time only the columns needed: numeric series, categories,
    and target against prediction.
    """
    model = baseline.for_model(model_id)
    missing = None
    if present_columns is not None:
        declared = batches.withColumn("column", F.explode(F.array(*[F.lit(c) for c in spec.features])))
        missing = declared.select("batch_id", "column").join(present_columns, ["batch_id", "column"], "left_anti")

    # What is pinned here has a row per batch, (batch, column) or (batch, level). Several branches
    # read it below: written once, it is never recomputed from the rows, and plans stay short.
    numbers = pinned(without_missing(numeric_summary(rows, spec, model.bins), missing, "series"))
    levels = pinned(without_missing(category_summary(rows, spec), missing, "feature"))

    labelled = batches.where("has_target").select("batch_id")
    violations = numeric_violations(numbers, spec, labelled)
    if spec.categorical:
        violations = violations.unionByName(category_violations(levels, spec))
    if present_columns is not None:
        violations = violations.unionByName(missing_column_violations(batches, spec, present_columns))
    if "n_target" in batches.columns:
        violations = violations.unionByName(row_count_violations(batches, spec))
    violations = pinned(violations)

    scored = rows.where("scored") if "scored" in rows.columns else rows
    series = series_psi(numbers, model)
    psi = pinned(feature_psi(series, levels, model, spec))
    facts = batch_facts(scored, spec.target, spec.prediction, n_features)
    reference = reference_metrics(model)
    frame = batch_frame(batches, facts, series, violations, reference)
    frame = pinned(frame)
    signals = pinned(batch_signals(frame, rules or {}).unionByName(drift_signals(psi, rules or {}, spec)))
    status = pinned(batch_status(frame, signals, psi, spec))
    return Monitored(violations, signals, psi, status, reference)
