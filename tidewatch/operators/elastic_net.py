"""Elastic-net searches from sufficient statistics: the rows are read once, whatever the size of the grid.

One aggregate gives the moments of features and label for each fold. The moments of all other folds together are the fitting
statistics of a fold, and both errors of any coefficients follow from moments alone. A grid point is then a descent on p x p
numbers, p being the number of encoded features, so the driver's work does not depend on the rows.

The objective is half the mean squared error + reg * (mix * |w|_1 + (1 - mix) / 2 * |w|_2^2), without a penalty on the
intercept. (Spark ML divides the quadratic penalty by the label's standard deviation; here both are on the label's scale.) Scaled
columns have mean 0 and variance 1 over the fitted rows (n - 1), the others stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .moments import pair_moments


@dataclass(frozen=True)
class Statistics:
    """Rows, means, and sums of mixed deviations of the features, the label last."""
    n: int
    means: np.ndarray
    co: np.ndarray

    def __add__(self, other: "Statistics") -> "Statistics":
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.means - self.means
        return Statistics(n, self.means + apart * (other.n / n), self.co + other.co + np.outer(apart, apart) * (self.n * other.n / n))

    def mean_squared_error(self, intercept: float, weights: np.ndarray) -> float:
        direction = np.append(-weights, 1.0)
        bias = float(direction @ self.means) - intercept
        return max(float(direction @ self.co @ direction) / self.n, 0.0) + bias * bias


def fold_statistics(df: DataFrame, features: Mapping[str, Column], label: Column, fold: Column, folds: int) -> list[Statistics]:
    """Statistics of each fold over the rows in which all features and the label are known."""
    columns = [*features.values(), label]
    complete = F.lit(True)
    for c in columns:
        complete &= F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")), F.lit(False))
    names = [f"c{i}" for i in range(len(columns))]
    wide = df.where(complete).select(fold.cast("int").alias("fold"), *[c.cast("double").alias(n) for c, n in zip(columns, names, strict=True)])
    size = len(names)
    found = {k: (0, np.zeros(size), np.zeros((size, size))) for k in range(folds)}
    for r in pair_moments(wide, {n: F.col(n) for n in names}, ["fold"]).where(F.col("fold").between(0, folds - 1)).collect():
        _, means, co = found[r.fold]
        i, j = int(r.left[1:]), int(r.right[1:])
        means[i], means[j], co[i, j], co[j, i] = r.mean_left, r.mean_right, r.co, r.co
        found[r.fold] = (r.n, means, co)
    return [Statistics(*found[k]) for k in range(folds)]


def _descent(gram: np.ndarray, target: np.ndarray, reg: float, mix: float, start: np.ndarray, tolerance: float, rounds: int) -> np.ndarray:
    """Coordinate descent on half w'Gw - w't + penalties, to the given change of the fit."""
    w, left = start.copy(), target - gram @ start
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(w)):
            if gram[j, j] <= 0:
                continue
            pull = left[j] + gram[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - reg * mix, 0.0) / (gram[j, j] + reg * (1 - mix))
            if new != w[j]:
                left -= gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * np.sqrt(gram[j, j]))
                w[j] = new
        if moved <= tolerance:
            break
    return w


def fitted(stats: Statistics, reg: float, mix: float, scaled: Sequence[bool], start: np.ndarray | None = None,
           tolerance: float = 1e-12, rounds: int = 100_000) -> tuple[float, np.ndarray, np.ndarray]:
    """(intercept, weights on the given columns, weights on the scaled ones) for one grid point."""
    spread = np.sqrt(np.diag(stats.co)[:-1] / max(stats.n - 1, 1))
    scale = np.where(np.array(scaled), spread, 1.0)
    factor = np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)  # a constant column has no weight
    gram = stats.co[:-1, :-1] * np.outer(factor, factor) / stats.n
    target = stats.co[:-1, -1] * factor / stats.n
    w = _descent(gram, target, reg, mix, np.zeros(len(factor)) if start is None else start, tolerance, rounds)
    weights = w * factor
    return float(stats.means[-1] - weights @ stats.means[:-1]), weights, w


@dataclass(frozen=True)
class PathSearch:
    """Scores of each grid point over the folds, and the fit of the best point on all rows."""
    trials: list[dict]
    best_params: dict[str, float]
    intercept: float
    weights: dict[str, float]
    n: int

    def prediction(self, features: Mapping[str, Column]) -> Column:
        """The fitted line as a column expression, so scoring stays in generated code."""
        total = F.lit(self.intercept)
        for name, weight in self.weights.items():
            if weight:
                total += features[name].cast("double") * F.lit(weight)
        return total


def search_path(df: DataFrame, features: Mapping[str, Column], label: Column, fold: Column, folds: int, grid: Mapping[str, Sequence[float]],
                scaled: Sequence[str] = (), family: str = "elasticnet") -> PathSearch:
    """Every grid point cross-validated, scored by the root mean squared error on the label's scale, and the best refitted.

    A grid axis is `regParam` or `elasticNetParam`. Ties go to the first point. Rows with an unknown feature or label take no part; a fold without
    rows is left out. Without any row there is nothing to fit, which is an error.
    """
    names = list(features)
    stats = fold_statistics(df, features, label, fold, folds)
    whole = sum(stats, Statistics(0, np.zeros(len(names) + 1), np.zeros((len(names) + 1,) * 2)))
    if not whole.n:
        raise ValueError("no complete row to fit")
    is_scaled = [n in set(scaled) for n in names]
    used = [k for k in range(folds) if stats[k].n and stats[k].n < whole.n]
    rest = {k: sum((s for j, s in enumerate(stats) if j != k), Statistics(0, whole.means, whole.co)) for k in used}
    mixes, regs = grid["elasticNetParam"], grid["regParam"]
    points = [(float(r), float(m)) for r in regs for m in mixes]
    scores: dict[tuple[float, float], tuple[list[float], list[float]]] = {p: ([], []) for p in points}
    for k in used:
        for mix in mixes:
            start = None
            for reg in sorted(set(map(float, regs)), reverse=True):  # along the path each fit starts from the one before
                intercept, weights, start = fitted(rest[k], reg, float(mix), is_scaled, start)
                test, train = scores[reg, float(mix)]
                test.append(stats[k].mean_squared_error(intercept, weights) ** 0.5)
                train.append(rest[k].mean_squared_error(intercept, weights) ** 0.5)
    trials = []
    for i, (reg, mix) in enumerate(points):
        test, train = scores[reg, mix]
        trials.append({"family": family, "trial": i, "params": json.dumps({"elasticNetParam": mix, "regParam": reg}, sort_keys=True),
                       "mean_test_rmse": float(np.mean(test)) if test else None, "std_test_rmse": float(np.std(test)) if test else None,
                       "mean_train_rmse": float(np.mean(train)) if train else None})
    best = min(range(len(points)), key=lambda i: trials[i]["mean_test_rmse"] if trials[i]["mean_test_rmse"] is not None else np.inf)
    intercept, weights, _ = fitted(whole, *points[best], is_scaled)
    return PathSearch(trials, {"regParam": points[best][0], "elasticNetParam": points[best][1]}, intercept,
                      dict(zip(names, map(float, weights), strict=True)), whole.n)
