import math

import numpy as np
import pytest
from conftest import NOW, people
from pyspark.sql import functions as F

from tidewatch.operators.baseline import build_baseline
from tidewatch.operators.contract import validate_rows, worst_severity
from tidewatch.operators.drift import psi_categorical, psi_numeric
from tidewatch.operators.metrics import canonical_metrics
from tidewatch.operators.profile import make_bins
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.report import consolidate, threshold_exceptions
from tidewatch.operators.summary import coerce_numeric
from tidewatch.functions import status_of
from tidewatch.plans.monitor import monitor
from tidewatch.spec import INSURANCE

MODEL = "m1"


def predicted(df, factor=1.0):
    return df.withColumn("prediction", F.col("charges") * (1 + F.randn(99) * 0.02) * factor)


@pytest.fixture(scope="module")
def baseline(spark):
    train = predicted(people(spark, 4000, 1))
    validation = predicted(people(spark, 1000, 50))
    built = build_baseline(train, validation, INSURANCE, MODEL, NOW, n_features=14)
    for part in (built.profile, built.bins, built.freqs, built.metrics):
        part.cache()
    return built


def run(spark, baseline, frames, rules=None):
    """frames: {batch: (rows, has_target)}"""
    rows, sizes = None, []
    for batch, (df, has_target) in frames.items():
        df = df.withColumn("batch_id", F.lit(batch))
        if not has_target:
            df = df.withColumn("charges", F.lit(None).cast("double"))
        rows = df if rows is None else rows.unionByName(df)
        n = df.count()
        sizes.append((batch, has_target, n, n if has_target else None))
    batches = spark.createDataFrame(
        [*sizes, ("empty", True, 0, 0)], "batch_id string, has_target boolean, n_features bigint, n_target bigint")
    out = monitor(coerce_numeric(rows, INSURANCE), batches, baseline, INSURANCE, MODEL, rules, n_features=14)
    return {r.batch_id: r for r in out.status.collect()}, out


def test_scenarios(spark, baseline):
    frames = {
        "healthy": (predicted(people(spark, 500, 7)), True),
        "scaled": (predicted(people(spark, 500, 7)).withColumn("charges", F.col("charges") * 100), True),
        "broken": (predicted(people(spark, 500, 7, bmi_factor=1000.0)), False),
        "drifted": (predicted(people(spark, 500, 7, age_shift=25), 0.4), True),
    }
    status, out = run(spark, baseline, frames)
    assert (status["healthy"].status, status["healthy"].diagnosis_code) == ("OK", "HEALTHY")
    assert (status["scaled"].status, status["scaled"].diagnosis_code) == ("ALERT", "LABEL_DATA_QUALITY")
    assert status["scaled"].psi_max < 0.10
    broken = status["broken"]
    assert (broken.status, broken.diagnosis_code, broken.psi_max_feature) == ("ALERT", "FEATURES_BROKEN_UNVERIFIABLE", "bmi")
    assert broken.rmse is None and broken.n_violations == 1
    assert (status["drifted"].status, status["drifted"].diagnosis_code) == ("ALERT", "RETRAIN_CANDIDATE")
    assert (status["empty"].status, status["empty"].diagnosis_code, status["empty"].n_rows, status["empty"].reconciled) == (
        "ALERT", "UNREADABLE", 0, False)
    names = [s.name for s in status["healthy"].signals]
    assert names == ["schema", "drift:age", "drift:bmi", "drift:children", "drift:sex", "drift:smoker", "drift:region",
                     "drift:predictions", "performance:rmse_ratio", "performance:r2_drop", "target:mean_shift", "target:psi"]
    no_changes = spark.createDataFrame([], "batch_id string, transition string")
    overall = consolidate(out.status, no_changes).first()
    assert (overall.overall_status, overall.n_batches, overall.n_ok, overall.n_warning, overall.n_alert, overall.new) == (
        "ALERT", 5, 1, 0, 4, 0)


def test_rules_decide_and_are_named(spark, baseline):
    rules = {"features": {"age": {"psi_warn": 0.0, "psi_alert": 9.0}}, "batches": {"b": {"schema_warn_pct": 50}}}
    status, out = run(spark, baseline, {"a": (predicted(people(spark, 300, 7)), True)}, rules)
    by_name = {s.name: s for s in status["a"].signals}
    assert by_name["drift:age"].status == "WARNING" and by_name["drift:age"].thresholds_source == "feature:age"
    assert by_name["drift:bmi"].thresholds_source == "default"
    found = [(r.batch_id, r.thresholds_source, r.signals) for r in threshold_exceptions(out.signals).collect()]
    assert found == [("a", "feature:age", ["drift:age"])]


def test_contract(spark):
    rows = spark.createDataFrame([
        ("x", "19", "female", 27900.0, 0.0, "yes", "southwest"), ("x", "abc", "FEMALE", 33770.0, 1.0, None, "mars"),
        ("y", "abc", "male", 30.0, float("nan"), "no", "northeast"), ("y", "zzz", "male", 30.0, 1.0, "no", "pluto"),
    ], "batch_id string, age string, sex string, bmi double, children double, smoker string, region string")
    found = {(r.batch_id, r.column, r.kind): (r.severity, r.n_rows, r.pct_rows) for r in validate_rows(rows, INSURANCE).collect()}
    assert found == {
        ("x", "age", "nulls"): ("ALERT", 1, 50.0), ("x", "bmi", "out_of_range"): ("ALERT", 2, 100.0),
        ("x", "smoker", "nulls"): ("ALERT", 1, 50.0), ("x", "region", "unknown_category"): ("ALERT", 1, 50.0),
        ("y", "age", "not_numeric"): ("ALERT", 2, 100.0), ("y", "children", "nulls"): ("ALERT", 1, 50.0),
        ("y", "region", "unknown_category"): ("ALERT", 1, 50.0),
    }
    absent = validate_rows(rows.drop("smoker"), INSURANCE)
    assert [(r.batch_id, r.n_rows, r.pct_rows) for r in absent.where("kind = 'missing_column'").orderBy("batch_id").collect()] == [
        ("x", 2, 100.0), ("y", 2, 100.0)]
    assert {tuple(r) for r in worst_severity(absent).collect()} == {("x", "ALERT"), ("y", "ALERT")}


@pytest.mark.parametrize("value, expected", [
    (0.10, "OK"), (0.10 + 1e-6, "WARNING"), (0.25, "WARNING"), (0.25 + 1e-6, "ALERT"), (float("nan"), "OK"), (None, "OK")])
def test_status_is_strict(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(status_of(F.col("v"), F.lit(0.10), F.lit(0.25))).first()[0] == expected


def psi_by_hand(reference, values, n_bins=10):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, n_bins + 1)))[1:-1]
    def freq(x):
        f = np.bincount(np.digitize(x, edges), minlength=len(edges) + 1) / len(x)
        f = np.clip(f, 1e-6, None)
        return f / f.sum()
    r, a = freq(reference), freq(values)
    return float(((a - r) * np.log(a / r)).sum())


def test_psi_numeric_against_numpy(spark):
    rng = np.random.default_rng(3)
    reference = np.concatenate([rng.normal(30, 6, 3000), np.full(1500, 31.0)])
    moved = rng.normal(36, 6, 800)
    ref = spark.createDataFrame([(float(v),) for v in reference], "value double").withColumn("series", F.lit("s"))
    rows = spark.createDataFrame([("same", float(v)) for v in reference] + [("moved", float(v)) for v in moved]
                                 + [("junk", float("nan")), ("junk", float("inf"))], "batch_id string, value double") \
        .withColumn("series", F.lit("s"))
    for n_bins, parts in ((10, 1), (10, 7), (20, 3), (3, 2)):
        bins = make_bins(ref, n_bins).cache()
        got = {r.batch_id: r.psi for r in psi_numeric(rows.repartition(parts), bins).collect()}
        assert abs(got["same"]) < 1e-12 and got["junk"] == 0.0
        assert math.isclose(got["moved"], psi_by_hand(reference, moved, n_bins), rel_tol=1e-9)


def test_psi_categorical_against_numpy(spark):
    reference = {"a": 0.5, "b": 0.3, "c": 0.2}
    batches = {"same": {"a": 50, "b": 30, "c": 20}, "new": {"a": 10, "d": 30}, "one": {"z": 5}}
    counts = spark.createDataFrame([(b, "f", c, n) for b, m in batches.items() for c, n in m.items()] + [("same", "f", None, 3)],
                                   "batch_id string, feature string, category string, n bigint")
    ref = spark.createDataFrame([("f", c, v) for c, v in reference.items()], "feature string, category string, freq double")
    got = {r.batch_id: r.psi for r in psi_categorical(counts, ref).collect()}
    for batch, seen in batches.items():
        names = sorted(set(reference) | set(seen))
        r = np.clip([reference.get(c, 0.0) for c in names], 1e-6, None)
        a = np.clip([seen.get(c, 0) / sum(seen.values()) for c in names], 1e-6, None)
        r, a = r / r.sum(), a / a.sum()
        assert math.isclose(got[batch], float(((a - r) * np.log(a / r)).sum()), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy):
    rng = np.random.default_rng(5)
    groups = {"heavy": np.concatenate([np.full(4000, 7.0), rng.lognormal(3, 4, 5000), [-1e300, 1e300]]),
              "few": np.array([3.0, 1.0]), "one": np.array([5.0]), "ties": rng.integers(0, 5, 3000).astype(float)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("few", float("nan")), ("few", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.01, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    for r in exact_quantiles(df, ["g"], "v", probs, accuracy).collect():
        assert r.n == len(groups[r.g])
        assert np.allclose(r.quantiles, np.quantile(groups[r.g], probs), rtol=1e-12)


def test_metrics(spark):
    rows = [("a", 1.0, 2.0), ("a", 0.0, 1.0), ("a", 4.0, 3.0), ("a", float("nan"), 1.0), ("a", 2.0, float("inf")),
            ("one", 5.0, 5.0), ("flat", 3.0, 3.0), ("flat", 3.0, 3.0), ("off", 3.0, 3.0), ("off", 3.0, 4.0), ("none", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, y double, p double")
    got = {r.k: r for r in canonical_metrics(df, ["k"], "y", "p", 1).collect()}
    y, p = np.array([1.0, 0.0, 4.0]), np.array([2.0, 1.0, 3.0])
    a = got["a"]
    assert a.n_samples == 3 and math.isclose(a.rmse, 1.0) and math.isclose(a.mae, 1.0)
    r2 = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert math.isclose(a.r2, r2) and math.isclose(a.mape, 62.5) and math.isclose(a.adj_r2, 1 - (1 - r2) * 2 / 1)
    assert math.isclose(a.rmse_log, float(np.sqrt(((np.log1p(y) - np.log1p(p)) ** 2).mean())))
    assert got["one"].r2 is None and got["flat"].r2 == 1.0 and got["off"].r2 == 0.0
    assert got["none"].n_samples == 0 and got["none"].rmse is None and got["none"].rmse_log is None
