"""Per-batch status and the consolidated report, from signals, metrics, violations and transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import label_of, rank_of
from ..spec import ALERT, STATUSES, FeatureSpec
from .shaping import ordinal_of
from .signals import diagnosis_code, problem_flags


def worst_status(signals: DataFrame) -> DataFrame:
    return signals.groupBy("batch_id").agg(label_of(F.max(rank_of(F.col("status")))).alias("status"))


def psi_extremes(psi: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Largest PSI and its feature (declared order breaks ties), and all values as a map."""
    order = F.struct("psi", (-ordinal_of(spec.features, F.col("feature"))).alias("o"))
    return psi.groupBy("batch_id").agg(
        F.max("psi").alias("psi_max"), F.max_by("feature", order).alias("psi_max_feature"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "psi")))).alias("psi"))


def batch_status(frame: DataFrame, signals: DataFrame, psi: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row per delivered batch. A batch without any readable row is an ALERT, not reconciled."""
    judged = signals.groupBy("batch_id").agg(
        F.max(rank_of(F.col("status"))).alias("_rank"), *problem_flags(spec),
        F.sort_array(F.collect_list(F.struct(
            "seq", "name", "category", "value", "status", "detail", "thresholds_source"))).alias("signals"))
    readable = F.col("n_rows") > 0
    return (
        frame.join(judged, "batch_id", "left").join(psi_extremes(psi, spec), "batch_id", "left")
        .select(
            "batch_id", "n_rows", "has_target",
            F.when(readable, label_of(F.col("_rank"))).otherwise(F.lit(ALERT)).alias("status"),
            F.when(readable, diagnosis_code(F.col("has_target"))).otherwise("UNREADABLE").alias("diagnosis_code"),
            readable.alias("reconciled"), "n_samples", "rmse", "mae", "r2", "mape", "rmse_log", "mae_log", "r2_log",
            "mape_log", "adj_r2", F.coalesce("psi_max", F.lit(0.0)).alias("psi_max"), "psi_max_feature", "psi",
            F.size("violations").cast("bigint").alias("n_violations"),
            "pred_mean", "pred_std", "pred_min", "pred_max", "signals", "violations")
    )


def _count_kind(kind: str) -> Column:
    return F.count_if(F.col("transition") == kind)


def transition_counts(transitions: DataFrame, batches: DataFrame) -> DataFrame:
    """new / ongoing / resolved per batch: zeros where nothing changed, null where not reconciled."""
    counts = transitions.groupBy("batch_id").agg(
        _count_kind("NEW").alias("new"), _count_kind("ONGOING").alias("ongoing"),
        _count_kind("RESOLVED").alias("resolved"))
    joined = batches.select("batch_id", "reconciled").join(counts, "batch_id", "left")
    return joined.select("batch_id", "reconciled", *[
        F.when(F.col("reconciled"), F.coalesce(c, F.lit(0))).alias(c) for c in ("new", "ongoing", "resolved")])


def total_transitions(transitions: DataFrame) -> DataFrame:
    return transitions.agg(_count_kind("NEW").alias("new"), _count_kind("ONGOING").alias("ongoing"),
                           _count_kind("RESOLVED").alias("resolved"))


def flat_report(status: DataFrame, reference: dict[str, float | None], transitions: DataFrame,
                run_id: str, at, model: dict | None = None) -> DataFrame:
    """The tabular view, one row per batch. Training run and scoring run stay two columns.

    `reference` holds the validation metrics the batches were judged by.
    """
    model = model or {}
    counts = transition_counts(transitions, status).drop("reconciled")
    return (
        status.join(counts, "batch_id", "left")
        .select(
            "batch_id", F.lit(at).cast("timestamp_ntz").alias("scored_at"), "n_rows", "has_target", "status",
            "rmse", "mae", "r2", "mape", F.lit(reference["val_rmse"]).cast("double").alias("baseline_rmse"),
            F.lit(reference["val_r2"]).cast("double").alias("baseline_r2"), "psi_max", "psi_max_feature", "n_violations", "pred_mean",
            *[F.coalesce(c, F.lit(0)).alias(f"alerts_{c}") for c in ("new", "ongoing", "resolved")],
            F.col("diagnosis_code").alias("diagnosis"),
            *[F.lit(model.get(c)).cast("string").alias(c) for c in ("model_name", "model_version", "model_source")],
            F.lit(model.get("training_run_id")).cast("string").alias("training_run_id"),
            F.lit(run_id).alias("run_id"))
    )


def monitoring_rows(status: DataFrame, flat: DataFrame) -> DataFrame:
    """The flat view with the whole report as JSON text, for the append-only monitoring table."""
    details = status.select("batch_id", F.to_json(F.struct("*")).alias("details"))
    return flat.join(details, "batch_id")


def consolidate(status: DataFrame, transitions: DataFrame) -> DataFrame:
    """One row: overall status, batches per status (zeros kept), alert totals."""
    both = status.select("status").unionByName(transitions.select("transition"), allowMissingColumns=True)
    return both.agg(
        label_of(F.max(F.when(F.col("status").isNotNull(), rank_of(F.col("status"))))).alias("overall_status"),
        F.count("status").alias("n_batches"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in STATUSES],
        _count_kind("NEW").alias("new"), _count_kind("ONGOING").alias("ongoing"), _count_kind("RESOLVED").alias("resolved"))


def threshold_exceptions(signals: DataFrame) -> DataFrame:
    """Signals decided by a custom rule, per (batch, rule), in the order the rules first appear."""
    custom = signals.where(F.col("thresholds_source") != "default")
    return custom.groupBy("batch_id", "thresholds_source").agg(
        F.array_sort(F.collect_set("name")).alias("signals"), F.min("seq").alias("first_seen"))
