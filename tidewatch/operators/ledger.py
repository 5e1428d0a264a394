"""Questions to the model ledger, answered for all models and versions at once.

Tables: versions (model, version, run_id, family, stage), runs (run_id, experiment, stage, status,
metrics...), aliases (model, alias, version). Versions are numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRODUCTION, STAGING = "production", "staging"

# Promotion gates.
MIN_R2 = 0.75
MAX_OVERFITTING = 0.15
MIN_IMPROVEMENT = 0.0


def latest_versions(versions: DataFrame) -> DataFrame:
    """The row with the highest version number of every model (a number: 10 comes after 9)."""
    rest = [c for c in versions.columns if c != "model"]
    return versions.groupBy("model").agg(
        F.max_by(F.struct(*rest), F.col("version").cast("bigint")).alias("v")).select("model", "v.*")


def best_runs(runs: DataFrame, metric: str = "val_rmse", mode: str = "min", stage: str = "training") -> DataFrame:
    """The best finished run of the training stage, per model."""
    done = runs.where((F.col("status") == "FINISHED") & (F.col("pipeline_stage") == stage))
    key = F.struct((-F.col(metric) if mode == "max" else F.col(metric)).alias("v"), "run_id")
    done = done.where(F.col(metric).isNotNull())
    return done.groupBy("model").agg(F.min_by(F.struct("run_id", metric), key).alias("r")).select("model", "r.*")


def alias_metrics(aliases: DataFrame, versions: DataFrame, runs: DataFrame) -> DataFrame:
    """alias -> version -> metrics of the run that produced it."""
    metrics = runs.select("run_id", "val_rmse", "val_r2", "overfitting_r2_diff")
    return (
        aliases.join(versions.select("model", "version", "run_id", "family"), ["model", "version"])
        .join(metrics, "run_id", "left")
        .select("model", "alias", "version", "run_id", "family", "val_rmse", "val_r2", "overfitting_r2_diff")
    )


def fingerprint(family: Column, *metrics: Column) -> Column:
    """Family and metrics at six decimals: what makes two versions indistinguishable."""
    return F.concat_ws("|", F.coalesce(family, F.lit("n/d")),
                       *[F.coalesce(F.format_string("%.6f", m), F.lit("-")) for m in metrics])


def duplicate_versions(candidates: DataFrame, versions: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Candidates equal to the latest version of their model (only the latest, not any version)."""
    latest = latest_versions(versions).select(
        "model", F.col("version").alias("duplicate_of"),
        fingerprint(F.col("family"), *[F.col(m) for m in metrics]).alias("_known"))
    print_of = fingerprint(F.col("family"), *[F.col(m) for m in metrics])
    return candidates.join(latest, "model").where(print_of == F.col("_known")).drop("_known")


def _first_reference(candidates: list[tuple[DataFrame, str]]) -> DataFrame:
    """The highest-priority row per model among several sources, with the name of its source."""
    ranked = None
    for priority, (df, source) in enumerate(candidates):
        part = df.select("model", F.lit(priority).alias("_p"), F.struct(
            F.lit(source).alias("source"), *[F.col(c).alias(c) for c in df.columns if c != "model"]).alias("pick"))
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked.groupBy("model").agg(F.min_by("pick", "_p").alias("pick")).select("model", "pick.*")


def resolve_models(aliases: DataFrame, versions: DataFrame, runs: DataFrame, metric: str = "val_rmse",
                   mode: str = "min") -> DataFrame:
    """The model to score with: production alias, else staging alias, else the best finished run."""
    def by_alias(name: str) -> DataFrame:
        return aliases.where(F.col("alias") == name).join(
            versions.select("model", "version", "run_id"), ["model", "version"]).select("model", "version", "run_id")

    best = best_runs(runs, metric, mode).select("model", F.lit(None).cast("bigint").alias("version"), "run_id")
    return _first_reference([
        (by_alias(PRODUCTION), f"registry:{PRODUCTION}"), (by_alias(STAGING), f"registry:{STAGING}"),
        (best, "run:best")])


def promotion_candidates(aliases: DataFrame, versions: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """The version to judge per model: the one asked for, else staging, else the latest."""
    sources = []
    if requested is not None:
        asked = requested.join(versions.select("model", "version", "run_id"), ["model", "version"])
        sources.append((asked.select("model", "version", "run_id"), "requested"))
    staged = aliases.where(F.col("alias") == STAGING).join(
        versions.select("model", "version", "run_id"), ["model", "version"]).select("model", "version", "run_id")
    sources += [(staged, STAGING), (latest_versions(versions).select("model", "version", "run_id"), "latest")]
    return _first_reference(sources)


def promotion_decisions(candidates: DataFrame, production: DataFrame, min_r2: float = MIN_R2,
                        max_overfitting: float = MAX_OVERFITTING,
                        min_improvement: float = MIN_IMPROVEMENT) -> DataFrame:
    """Judge every candidate against the gates.

    `candidates` has model, version, val_r2, val_rmse, overfitting_r2_diff; `production` has model,
    version, val_rmse. A candidate already in production is a no-op, whatever the gates say.
    """
    current = production.select("model", F.col("version").alias("production_version"),
                                F.col("val_rmse").alias("production_rmse"))
    rows = candidates.join(current, "model", "left")
    limit = F.col("production_rmse") * (1 - min_improvement)
    gates = {
        "r2_gate": F.when(F.col("val_r2").isNull(), "REJECT_MISSING")
        .when(F.col("val_r2") < min_r2, "REJECT").otherwise("OK"),
        "overfitting_gate": F.when(F.col("overfitting_r2_diff").isNull(), "NOTICE_MISSING")
        .when(F.col("overfitting_r2_diff") >= max_overfitting, "REJECT").otherwise("OK"),
        "improvement_gate": F.when(F.col("production_rmse").isNull(), "OK_NO_PRODUCTION")
        .when(F.col("val_rmse").isNull(), "REJECT_MISSING")
        .when(F.col("val_rmse") <= limit, "OK").otherwise("REJECT"),
    }
    judged = rows.withColumns(gates)
    passed = ~(F.startswith(F.col("r2_gate"), F.lit("REJECT")) | F.startswith(F.col("overfitting_gate"), F.lit("REJECT"))
               | F.startswith(F.col("improvement_gate"), F.lit("REJECT")))
    reasons = F.array(*[F.concat(F.lit(f"{name.removesuffix('_gate')}: "), F.col(name)) for name in gates])
    action = F.when(F.col("version") == F.col("production_version"), "NOOP").when(passed, "PROMOTE").otherwise("REJECT")
    return judged.withColumns({"passed": passed, "reasons": reasons, "action": action})


@dataclass(frozen=True)
class Ledger:
    versions: DataFrame
    aliases: DataFrame


def register_runs(ledger: Ledger, runs: DataFrame, metrics: tuple[str, ...]) -> Ledger:
    """The next snapshot after training runs (model, run_id, family, metrics): a new version each, and the staging alias.

    A run that is equal to the latest version of its model is no new version. Of several runs of one model the
    versions follow the order of run_id, and the last one is staged.
    """
    known = duplicate_versions(runs, ledger.versions, metrics).select("model", "run_id")
    latest = latest_versions(ledger.versions).select("model", F.col("version").alias("_latest"))
    order = Window.partitionBy("model").orderBy("run_id")
    new = (runs.join(known, ["model", "run_id"], "left_anti").join(latest, "model", "left")
           .withColumn("version", (F.coalesce("_latest", F.lit(0)) + F.row_number().over(order)).cast("bigint")).drop("_latest")
           .withColumn("stage", F.lit("Staging")))
    staged = new.groupBy("model").agg(F.max("version").alias("version"))
    others = ledger.aliases.join(staged.select("model", F.lit(STAGING).alias("alias")), ["model", "alias"], "left_anti")
    aliases = others.select("model", "alias", "version").unionByName(
        staged.select("model", F.lit(STAGING).alias("alias"), "version"))
    return Ledger(ledger.versions.unionByName(new.select(*[c for c in ledger.versions.columns if c in new.columns]),
                                              allowMissingColumns=True), aliases)


def apply_promotions(ledger: Ledger, decisions: DataFrame, at) -> Ledger:
    """The next snapshot of both tables: the new version serves, the previous one is archived.

    A rejected candidate is stamped with the time and the whole reason.
    """
    time = F.lit(at).cast("timestamp_ntz")
    moved = decisions.where(F.col("action") == "PROMOTE").select(
        "model", F.col("version").alias("new_version"), "production_version",
        F.array_join("reasons", " | ").alias("reason"))
    refused = decisions.where(F.col("action") == "REJECT").select(
        "model", F.col("version").alias("rejected_version"), F.array_join("reasons", " | ").alias("rejection"))
    joined = ledger.versions.join(moved, "model", "left").join(refused, "model", "left")
    rejected = F.coalesce(F.col("version") == F.col("rejected_version"), F.lit(False))
    promoted = F.col("version") == F.col("new_version")
    replaced = (F.col("version") == F.col("production_version")) & F.col("new_version").isNotNull()

    def stamped(name: str, condition: Column, value: Column) -> Column:
        earlier = F.col(name) if name in ledger.versions.columns else F.lit(None)
        return F.when(condition, value).otherwise(earlier)

    versions = joined.withColumns({
        "stage": F.when(promoted, "Production").when(replaced, "Archived").otherwise(F.col("stage")),
        "promoted_at": stamped("promoted_at", promoted, time),
        "promotion_reason": stamped("promotion_reason", promoted, F.col("reason")),
        "archived_at": stamped("archived_at", replaced, time),
        "superseded_by": stamped("superseded_by", replaced, F.col("new_version")),
        "rejected_at": stamped("rejected_at", rejected, time),
        "rejection_reason": stamped("rejection_reason", rejected, F.col("rejection")),
    }).drop("new_version", "production_version", "reason", "rejected_version", "rejection")

    stale = ledger.aliases.join(moved.select("model", "new_version"), "model", "left").where(
        F.col("new_version").isNull()
        | ~((F.col("alias") == PRODUCTION) | ((F.col("alias") == STAGING) & (F.col("version") == F.col("new_version")))))
    aliases = stale.select("model", "alias", "version").unionByName(
        moved.select("model", F.lit(PRODUCTION).alias("alias"), F.col("new_version").alias("version")))
    return Ledger(versions, aliases)


def reproduction_check(declared: DataFrame, measured: DataFrame, keys: list[str], tolerance: float = 0.01) -> DataFrame:
    """Declared against measured metrics; a relative gap within the tolerance reproduces."""
    gap = F.col("measured") - F.col("declared")
    relative = F.when(F.col("declared") == 0, 0.0).otherwise(F.try_divide(F.abs(gap), F.abs(F.col("declared"))))
    joined = declared.withColumnRenamed("value", "declared").join(
        measured.withColumnRenamed("value", "measured"), [*keys, "metric"])
    return joined.withColumns({"delta": gap, "relative": relative, "reproduced": F.coalesce(relative <= tolerance, F.lit(False))})
