"""A promotion run over the ledger: choose candidates, judge them, and write the next snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.ledger import PRODUCTION, Ledger, alias_metrics, apply_promotions, promotion_candidates, promotion_decisions


@dataclass(frozen=True)
class Promotion:
    decisions: DataFrame
    ledger: Ledger | None    # None for a dry run


def promote(ledger: Ledger, runs: DataFrame, at, requested: DataFrame | None = None, dry_run: bool = False,
            **gates: float) -> Promotion:
    """Decide for all models at once; a dry run only returns the decisions."""
    metrics = runs.select("run_id", "val_rmse", "val_r2", "overfitting_r2_diff")
    candidates = promotion_candidates(ledger.aliases, ledger.versions, requested).join(metrics, "run_id", "left")
    serving = alias_metrics(ledger.aliases.where(f"alias = '{PRODUCTION}'"), ledger.versions, runs)
    decisions = promotion_decisions(candidates, serving, **gates)
    return Promotion(decisions, None if dry_run else apply_promotions(ledger, decisions, at))
