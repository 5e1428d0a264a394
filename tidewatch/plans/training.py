"""A training run: split, search every family, compare, choose, and build the winner's baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.baseline import Baseline, build_baseline
from ..operators.features import category_levels, encoded_names
from ..operators.selection import comparison_table, select_best
from ..operators.training import CATALOG, Family, Search, candidates_table, requested, predict, search_family, split_rows
from ..session import pinned
from ..spec import FeatureSpec


@dataclass(frozen=True)
class TrainedRun:
    winner: Search
    choice: DataFrame        # winner, runner-up, rankings_disagree
    comparison: DataFrame
    searches: list[Search]
    baseline: Baseline
    feature_names: list[str]


def train(rows: DataFrame, spec: FeatureSpec, key: Sequence[str], model_id: str, at, families: Sequence[str] | None = None,
          budget: int = 50, folds: int = 5, parallelism: int = 2, metric: str = "val_rmse", mode: str = "min",
          catalog: Mapping[str, Family] = CATALOG) -> TrainedRun:
    """All families share one split, which is written once and read by every fit."""
    split = pinned(split_rows(rows, key))
    train_rows = split.where(F.col("split") == "train")
    levels = category_levels(train_rows, spec.categorical)
    names = encoded_names(spec, levels)
    searches = [search_family(train_rows, f, spec, levels, key, budget, folds, parallelism)
                for f in requested(catalog if families is None else families, catalog)]
    run = F.lit("run").alias("comparison")
    candidates = pinned(candidates_table(searches, split, spec, len(names), budget, catalog).select(run, "*"))
    choice = select_best(candidates, ["comparison"], metric, mode)
    best = choice.first().winner
    winner = next(s for s in searches if s.family.name == best)
    validation = predict(winner.model, split.where(F.col("split") == "validation"), spec)
    return TrainedRun(winner, choice, comparison_table(candidates, ["comparison"], metric, mode), searches,
                      build_baseline(train_rows, validation, spec, model_id, at, len(names)), names)
