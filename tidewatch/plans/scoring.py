"""A scoring run over a directory of batch files, from the files to the alert state."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import Reconciled, reconcile
from ..operators.baseline import Baseline
from ..operators.features import with_provenance, with_row_errors
from ..operators.report import consolidate, flat_report, monitoring_rows
from ..operators.training import predict
from ..session import pinned
from ..sources import tables
from ..sources.batches import load_batches
from ..spec import FeatureSpec
from .monitor import Monitored, monitor


@dataclass(frozen=True)
class ScoredRun:
    rows: DataFrame
    monitored: Monitored
    alerts: Reconciled
    flat: DataFrame
    summary: DataFrame


def score_directory(spark: SparkSession, directory: str, model: PipelineModel, baseline: Baseline, spec: FeatureSpec,
                    model_id: str, state: DataFrame, run_id: str, at, rules: Mapping | None = None,
                    n_features: int | None = None, provenance: Mapping[str, str] | None = None) -> ScoredRun:
    """Load, predict, monitor and reconcile every batch of the directory in one plan, not one by one.

    A missing column leaves that feature unknown to the model and raises the contract alert; a batch with no
    readable row becomes an ALERT that resolves nothing.
    """
    loaded = load_batches(spark, directory, spec)
    # the join by position and the model run once; monitoring and the sinks read columns of the result
    scored = pinned(predict(model, loaded.rows, spec))
    seen = monitor(scored, loaded.batches, baseline, spec, model_id, dict(rules or {}), n_features, loaded.columns)
    reconciled = seen.status.where("reconciled").select("batch_id")
    merged = reconcile(state, seen.signals, reconciled, run_id, at, model_id)
    merged = Reconciled(pinned(merged.state), pinned(merged.transitions), pinned(merged.closed))
    rows = with_provenance(with_row_errors(scored.where("scored"), spec.target, spec.prediction),
                           {"model_id": model_id, **(provenance or {})}, run_id, at).drop("unparsed", "scored")
    flat = flat_report(seen.status, seen.reference, merged.transitions, run_id, at, dict(provenance or {}))
    return ScoredRun(rows, seen, merged, flat, consolidate(seen.status, merged.transitions))


def write_run(run: ScoredRun, path: str, run_id: str, run_number: int) -> None:
    """Predictions, monitoring rows, reports, transitions and the next alert state."""
    tables.append_predictions(run.rows, f"{path}/predictions", run_id)
    tables.append_monitoring(monitoring_rows(run.monitored.status, run.flat), f"{path}/monitoring", run_id)
    tables.write_report(run.monitored.status, run.flat, f"{path}/reports", run_id)
    tables.append_run(run.alerts.transitions, f"{path}/transitions", run_id)
    tables.append_run(run.alerts.closed, f"{path}/closed_alerts", run_id)
    tables.save_state(run.alerts.state, f"{path}/alerts", run_number)


def fail_on_alert(run: ScoredRun) -> None:
    """For schedulers that should stop on a red run."""
    red = run.monitored.status.where(F.col("status") == "ALERT").agg(F.count("*"), F.min("batch_id"), F.max("batch_id")).first()
    if red[0]:
        raise RuntimeError(f"{red[0]} batches in ALERT, from {red[1]} to {red[2]}; the status table lists them")
