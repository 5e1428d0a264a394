"""The five monitoring signals of every batch, and the diagnosis drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import finite, status_of
from ..spec import OK, PREDICTION_SERIES, STRUCTURAL_KINDS, TARGET_SERIES, FeatureSpec
from .baseline import Baseline
from .contract import VIOLATION_KINDS
from .drift import psi_categorical, psi_of
from .profile import as_frequencies
from .rules import resolve_thresholds
from .shaping import ordinal_of

SIGNAL_COLUMNS = ["batch_id", "seq", "name", "category", "value", "status", "detail", "thresholds_source"]


def series_psi(summary: DataFrame, baseline: Baseline) -> DataFrame:
    """(batch_id, series, psi, baseline_mean, batch_mean, n_values) of every numeric series."""
    known = baseline.bins.select("series", "freqs").join(
        F.broadcast(baseline.profile.select("series", F.col("mean").alias("baseline_mean"))), "series")
    total = F.aggregate(F.coalesce("counts", F.array().cast("array<bigint>")), F.lit(0).cast("bigint"),
                        lambda a, c: a + c)
    psi = F.when((F.size("freqs") >= 2) & (total > 0), psi_of(F.col("freqs"), as_frequencies(F.col("counts")))).otherwise(0.0)
    # the baseline of one model: a row per declared series
    return summary.join(F.broadcast(known), "series").select(
        "batch_id", "series", psi.alias("psi"), "baseline_mean",
        F.col("mean").alias("batch_mean"), (F.col("n_rows") - F.col("n_null")).alias("n_values"))


def feature_psi(series: DataFrame, categories: DataFrame, baseline: Baseline, spec: FeatureSpec) -> DataFrame:
    """(batch_id, feature, psi, baseline_mean, batch_mean) of every baseline feature a batch has.

    A column whose batch values are all null keeps a PSI of zero.
    """
    numbers = series.where(F.col("series").isin(*spec.numeric)).select(
        "batch_id", F.col("series").alias("feature"), "psi", "baseline_mean", "batch_mean")
    if not spec.categorical:
        return numbers
    levels = psi_categorical(categories.where("n > 0"), baseline.freqs)
    present = categories.select("batch_id", "feature").distinct().join(
        F.broadcast(baseline.freqs.select("feature").distinct()), "feature")  # a row per declared column
    nothing = F.lit(None).cast("double")
    texts = present.join(levels, ["batch_id", "feature"], "left").select(
        "batch_id", "feature", F.coalesce("psi", F.lit(0.0)).alias("psi"),
        nothing.alias("baseline_mean"), nothing.alias("batch_mean"))
    return numbers.unionByName(texts)


def drift_signals(psi: DataFrame, rules, spec: FeatureSpec) -> DataFrame:
    """The only signal whose thresholds resolve per feature."""
    judged = resolve_thresholds(psi, rules, per_feature=True)
    detail = F.when(F.col("feature").isin(*spec.categorical), F.format_string("PSI=%.4f (categorical)", "psi")) \
        .otherwise(F.format_string("PSI=%.4f | baseline mean=%.3f -> batch=%.3f", "psi", "baseline_mean", "batch_mean"))
    return judged.select(
        "batch_id", (ordinal_of(spec.features, F.col("feature")) + 100).alias("seq"),
        F.concat(F.lit("drift:"), "feature").alias("name"), F.lit("feature_drift").alias("category"),
        F.col("psi").alias("value"), status_of(F.col("psi"), F.col("psi_warn"), F.col("psi_alert")).alias("status"),
        detail.alias("detail"), F.col("sources")["psi"].alias("thresholds_source"))


def reference_metrics(baseline: Baseline) -> dict[str, float | None]:
    """val_rmse and val_r2 of one model's baseline: two numbers, used as constants of the run."""
    rows = baseline.metrics.where(F.col("metric").isin("val_rmse", "val_r2")).select("metric", "value").collect()
    return {"val_rmse": None, "val_r2": None} | {r.metric: r.value for r in rows}


def batch_frame(batches: DataFrame, facts: DataFrame, series: DataFrame, violations: DataFrame,
                reference: dict[str, float | None]) -> DataFrame:
    """Everything the batch-level signals are judged by, one row per delivered batch.

    Metrics of a batch without labels are null.
    """
    def of(name: str, column: str, alias: str) -> Column:
        return F.max(F.when(F.col("series") == name, F.col(column))).alias(alias)

    special = series.where(F.col("series").isin(PREDICTION_SERIES, TARGET_SERIES)).groupBy("batch_id").agg(
        of(PREDICTION_SERIES, "psi", "p_psi"), of(PREDICTION_SERIES, "baseline_mean", "p_base"),
        of(PREDICTION_SERIES, "batch_mean", "p_mean"), of(TARGET_SERIES, "psi", "t_psi"),
        of(TARGET_SERIES, "baseline_mean", "t_base"), of(TARGET_SERIES, "batch_mean", "t_mean"),
        of(TARGET_SERIES, "n_values", "t_values"))
    broken = violations.groupBy("batch_id").agg(F.sort_array(F.collect_list(
        F.struct("column", "kind", "severity", "n_rows", "pct_rows", "detail"))).alias("violations"))
    metrics = [c for c in facts.columns if c not in ("batch_id", "n_rows") and not c.startswith("pred_")]
    joined = (
        batches.select("batch_id", "has_target").join(facts, "batch_id", "left").join(special, "batch_id", "left")
        .join(broken, "batch_id", "left")
        .withColumns({name: F.lit(value).cast("double") for name, value in reference.items()})
    )
    return joined.withColumns({c: F.when(F.col("has_target"), F.col(c)) for c in metrics} | {
        "n_rows": F.coalesce("n_rows", F.lit(0)).cast("bigint"),
        "violations": F.coalesce("violations", F.array())})


def _signal(seq: int, name: Column, category: str, value: Column, status: Column, detail: Column, group: str) -> Column:
    return F.struct(
        F.lit(seq).alias("seq"), name.alias("name"), F.lit(category).alias("category"),
        value.cast("double").alias("value"), status.alias("status"), detail.alias("detail"),
        F.coalesce(F.col("sources")[group], F.lit("default")).alias("thresholds_source"))


def schema_signal(violation: Column) -> Column:
    """A violation re-judged with the batch's thresholds; structural kinds keep their severity."""
    status = F.when(violation["kind"].isin(*STRUCTURAL_KINDS), violation["severity"]).otherwise(
        status_of(violation["pct_rows"], F.col("schema_warn_pct"), F.col("schema_alert_pct")))
    return _signal(0, F.concat_ws(":", F.lit("schema"), violation["column"], violation["kind"]), "schema",
                   violation["pct_rows"], status, F.concat_ws(": ", violation["column"], violation["detail"]), "schema")


def batch_signals(frame: DataFrame, rules) -> DataFrame:
    """Schema, prediction, performance and target signals of every readable batch.

    All are read off one row per batch, so they cost no join among themselves.
    """
    psi = ("psi_warn", "psi_alert")

    def judged(value: Column, fields: tuple[str, str]) -> Column:
        return status_of(value, F.col(fields[0]), F.col(fields[1]))

    labelled = F.col("has_target")
    base_rmse, base_r2, base_mean = finite(F.col("val_rmse")), finite(F.col("val_r2")), finite(F.col("t_base"))
    ratio, drop = F.try_divide(F.col("rmse"), base_rmse), base_r2 - F.col("r2")
    shift = F.abs(F.try_divide(F.col("t_mean"), base_mean) - 1)
    p_psi, t_psi = F.coalesce("p_psi", F.lit(0.0)), F.coalesce("t_psi", F.lit(0.0))
    fixed = [
        (F.size("violations") == 0, _signal(
            0, F.lit("schema"), "schema", F.lit(0.0), F.lit(OK), F.lit("data contract respected"), "schema")),
        (F.lit(True), _signal(
            10_000, F.lit("drift:predictions"), "prediction_drift", p_psi, judged(p_psi, psi),
            F.format_string("PSI=%.4f | baseline mean=%.2f -> batch=%.2f", p_psi, "p_base", "p_mean"), "psi")),
        (labelled & (base_rmse > 0), _signal(
            10_001, F.lit("performance:rmse_ratio"), "performance", ratio,
            judged(ratio, ("perf_warn_ratio", "perf_alert_ratio")),
            F.format_string("RMSE batch=%.2f vs validation=%.2f", "rmse", "val_rmse"), "perf")),
        (labelled & base_r2.isNotNull(), _signal(
            10_002, F.lit("performance:r2_drop"), "performance", drop, judged(drop, ("r2_warn_drop", "r2_alert_drop")),
            F.format_string("R2 batch=%.4f vs validation=%.4f", "r2", "val_r2"), "r2")),
        (labelled & (base_mean != 0) & (F.col("t_values") > 0), _signal(
            10_003, F.lit("target:mean_shift"), "target_drift", shift,
            judged(shift, ("target_shift_warn", "target_shift_alert")),
            F.format_string("baseline mean=%.2f -> batch=%.2f", "t_base", "t_mean"), "target_shift")),
        (labelled, _signal(
            10_004, F.lit("target:psi"), "target_drift", t_psi, judged(t_psi, psi),
            F.format_string("PSI of the target distribution=%.4f", t_psi), "psi")),
    ]
    found = F.array_compact(F.array(*[F.when(condition, item) for condition, item in fixed]))
    all_of = F.concat(F.transform("violations", schema_signal), found)
    ready = resolve_thresholds(frame.where(F.col("n_rows") > 0), rules)
    return ready.select("batch_id", F.explode(all_of).alias("s")).select("batch_id", "s.*")


def problem_flags(spec: FeatureSpec) -> list[Column]:
    """Per-batch aggregates over signals: where is the problem?"""
    bad = F.col("status") != OK
    of_target = F.col("name").isin(*[f"schema:{spec.target}:{kind}" for kind in VIOLATION_KINDS])

    def any_bad(condition: Column) -> Column:
        return F.coalesce(F.bool_or(bad & condition), F.lit(False))

    category = F.col("category")
    return [
        any_bad((category == "feature_drift") | ((category == "schema") & ~of_target)).alias("features_bad"),
        any_bad((category == "target_drift") | ((category == "schema") & of_target)).alias("target_bad"),
        any_bad(category == "performance").alias("performance_bad"),
        any_bad(category == "prediction_drift").alias("predictions_bad"),
    ]


def diagnosis_code(has_target: Column) -> Column:
    """First match wins."""
    f, t, p, q = (F.col(c) for c in ("features_bad", "target_bad", "performance_bad", "predictions_bad"))
    unlabelled = (
        F.when(f, "FEATURES_BROKEN_UNVERIFIABLE").when(q, "PREDICTIONS_SHIFTED").otherwise("UNLABELLED_STABLE"))
    return (
        F.when(~has_target, unlabelled)
        .when(t & ~f, "LABEL_DATA_QUALITY")
        .when(f & p, "RETRAIN_CANDIDATE")
        .when(f, "COVARIATE_DRIFT_ONLY")
        .when(p, "CONCEPT_DRIFT")
        .otherwise("HEALTHY")
    )
