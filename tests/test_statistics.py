"""Co-moments and elastic-net searches against direct computations and Spark ML."""

import json
import math

import numpy as np
import pytest
from conftest import people
from pyspark.sql import functions as F

from tidewatch.operators import training
from tidewatch.operators.eda import correlations
from tidewatch.operators.elastic_net import fold_statistics, search_path
from tidewatch.operators.moments import pair_moments
from tidewatch.operators.training import CATALOG, LABEL, build_pipeline
from tidewatch.spec import FeatureSpec


def awkward(spark, n=400):
    """Nulls in both columns, NaN, infinities, a constant, and values far from zero."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(n):
        x, y = float(rng.normal()), float(rng.normal())
        rows.append((k % 3, None if k % 7 == 0 else x, math.nan if k % 11 == 0 else x + y, 4.0,
                     1e9 + y, math.inf if k == 5 else None if k % 5 == 0 else y))
    return spark.createDataFrame(rows, "g int, a double, b double, c double, d double, e double")


@pytest.mark.parametrize("copies", [1, 5])
def test_pair_moments(spark, copies):
    """25 columns need more sums than one aggregate holds; the result is the same for each copy."""
    df = awkward(spark)
    columns = {f"{c}{k}": F.col(c) for k in range(copies) for c in "abcde"}
    got = {(r.g, r.left, r.right): r for r in pair_moments(df, columns, ["g"]).collect()}
    assert len(got) == 3 * len(columns) * (len(columns) + 1) // 2
    rows = df.collect()
    for (g, left, right), r in got.items():
        pairs = [(q[left[0]], q[right[0]]) for q in rows if q.g == g]
        pairs = np.array([p for p in pairs if all(v is not None and math.isfinite(v) for v in p)])
        assert r.n == len(pairs)
        apart = pairs - pairs.mean(axis=0)
        assert np.allclose([r.mean_left, r.mean_right], pairs.mean(axis=0), rtol=1e-12)
        assert np.allclose([r.m2_left, r.m2_right, r.co], [(apart[:, 0] ** 2).sum(), (apart[:, 1] ** 2).sum(), apart.prod(axis=1).sum()], atol=1e-5)


def test_correlations_of_awkward_columns(spark):
    got = {(r.left, r.right): r["corr"] for r in correlations(awkward(spark), list("abcde")).collect()}
    assert len(got) == 25 and got["c", "a"] is None and got["c", "c"] is None and got["a", "a"] == 1.0
    assert got["a", "b"] == got["b", "a"] and 0.6 < got["a", "b"] < 0.8 and got["d", "e"] > 0.999
    nothing = {(r.left, r.right): r["corr"] for r in correlations(awkward(spark).limit(0), ["a", "b"]).collect()}
    assert not any(v is not None for v in nothing.values())


SPEC = FeatureSpec(("age", "bmi", "children"), ("smoker",), "charges")


def insured(spark):
    rows = people(spark, 600, 5).withColumn("charges", F.col("charges") + 300 * F.col("bmi")).cache()
    features = {c: F.col(c) for c in SPEC.numeric} | {"smoker_yes": (F.col("smoker") == "yes").cast("int")}
    return rows, features, (F.col("row_index") % 3).cast("int")


def test_lasso_equals_spark_ml(spark):
    """Without a quadratic penalty both have one objective: equal fold errors and predictions."""
    rows, features, fold = insured(spark)
    found = search_path(rows, features, F.log1p("charges"), fold, 3, {"regParam": [0.01, 0.1], "elasticNetParam": [1.0]}, SPEC.numeric)
    labelled = rows.withColumn(LABEL, F.log1p("charges"))
    family, levels = CATALOG["elasticnet"], {"smoker": ["no", "yes"]}
    for trial in found.trials:
        errors = []
        for k in range(3):
            model = build_pipeline(family, SPEC, levels, json.loads(trial["params"]) | {"tol": 1e-12}).fit(labelled.where(fold != k))
            scored = model.transform(labelled.where(fold == k))
            errors.append(scored.select(F.sqrt(F.avg((F.col(LABEL) - F.col(training.LOG_PREDICTION)) ** 2))).first()[0])
        assert abs(np.mean(errors) - trial["mean_test_rmse"]) < 1e-6
    best = min(found.trials, key=lambda t: t["mean_test_rmse"])
    assert json.loads(best["params"]) == found.best_params
    model = build_pipeline(family, SPEC, levels, found.best_params | {"tol": 1e-12}).fit(labelled)
    worst = model.transform(labelled).select(F.max(F.abs(F.col(training.LOG_PREDICTION) - found.prediction(features)))).first()[0]
    assert worst < 1e-5


@pytest.mark.parametrize("reg", [0.001, 0.05])
@pytest.mark.parametrize("mix", [0.0, 0.3, 0.9])
def test_elastic_net_is_optimal(spark, reg, mix):
    """No weight can be moved to lower the objective over the rows themselves."""
    rows, features, fold = insured(spark)
    found = search_path(rows, features, F.log1p("charges"), fold, 3, {"regParam": [reg], "elasticNetParam": [mix]}, SPEC.numeric)
    data = np.array(rows.select(*[c.cast("double") for c in features.values()], F.log1p("charges")).collect())
    x, y, w = data[:, :-1], data[:, -1], np.array(list(found.weights.values()))
    scale = np.array([x[:, j].std(ddof=1) if n in SPEC.numeric else 1.0 for j, n in enumerate(features)])
    left = y - found.intercept - x @ w
    assert abs(left.mean()) < 1e-9
    pull = ((x - x.mean(axis=0)) / scale).T @ left / len(y)
    for p, v in zip(pull, w * scale, strict=True):
        assert abs(p - reg * mix * np.sign(v) - reg * (1 - mix) * v) < 1e-8 if v else abs(p) <= reg * mix + 1e-9


def test_elastic_net_of_awkward_rows(spark):
    """A constant column has no weight, incomplete rows and unused folds take no part, and no row is an error."""
    rows = spark.range(40).select("id", (F.col("id") % 7).cast("double").alias("x"), F.lit(2.0).alias("k"),
                                  F.when(F.col("id") % 9 == 0, None).otherwise(3 * (F.col("id") % 7) + 1.0).alias("y"))
    features = {"x": F.col("x"), "k": F.col("k")}
    found = search_path(rows, features, F.col("y"), (F.col("id") % 2).cast("int"), 5, {"regParam": [0.0], "elasticNetParam": [0.5]}, ["x"])
    assert abs(found.weights["x"] - 3) < 1e-9 and found.weights["k"] == 0.0 and abs(found.intercept - 1) < 1e-8 and found.n == 35
    stats = fold_statistics(rows, features, F.col("y"), (F.col("id") % 2).cast("int"), 5)
    assert [s.n for s in stats] == [17, 18, 0, 0, 0]
    with pytest.raises(ValueError):
        search_path(rows.limit(0), features, F.col("y"), F.lit(0), 2, {"regParam": [0.1], "elasticNetParam": [0.5]})
