from datetime import timedelta

import pytest
from conftest import NOW, people
from pyspark.sql import functions as F

from tidewatch.operators import training
from tidewatch.operators.alerts import empty_state
from tidewatch.operators.ledger import Ledger
from tidewatch.plans.promotion import promote
from tidewatch.plans.scoring import fail_on_alert, score_directory, write_run
from tidewatch.plans.training import train
from tidewatch.sources.tables import load_baseline, load_state, save_baseline
from tidewatch.spec import INSURANCE

SMALL = {
    "random_forest": training.Family("random_forest", "Forest", training.RandomForestRegressor, {"seed": 42}, {"numTrees": [10], "maxDepth": [7]}, importance="gain"),
    "elasticnet": training.Family("elasticnet", "Elastic net", training.LinearRegression, {"standardization": False}, {"regParam": [0.01], "elasticNetParam": [0.5]},
                                  scaled=True, importance="abs_coef"),
}


def put(rows, directory, batch, factor, target=True):
    ordered = rows.orderBy("row_index")
    ordered.select("age", "sex", (F.col("bmi")).alias("bmi"), "children", "smoker", "region").coalesce(1) \
        .write.option("header", "true").csv(f"{directory}/dataset_{batch}_feats.csv.csv")
    if target:
        text = F.translate((F.col("charges") * factor).cast("decimal(18,2)").cast("string"), ".", ",")
        ordered.select(text.alias("charges")).coalesce(1).write.text(f"{directory}/dataset_{batch}_target.csv.csv")


def test_train_then_score_three_batches(spark, tmp_path):
    trained = train(people(spark, 1500, 21), INSURANCE, ["row_index"], "m1", NOW, budget=2, folds=2, catalog=SMALL)
    assert trained.winner.family.name == "random_forest" and len(trained.feature_names) == 14
    assert [r.family for r in trained.comparison.collect()] == ["random_forest", "elasticnet"]
    save_baseline(trained.baseline, str(tmp_path / "baseline"))
    baseline = load_baseline(spark, str(tmp_path / "baseline"))

    directory = str(tmp_path / "prod")
    put(people(spark, 800, 31), directory, "prod1", 1)
    put(people(spark, 800, 32), directory, "prod2", 100)
    put(people(spark, 800, 33, bmi_factor=1000.0), directory, "prod3", 1, target=False)
    run = score_directory(spark, directory, trained.winner.model, baseline, INSURANCE, "m1", empty_state(spark), "r1", NOW,
                          n_features=14, provenance={"model_name": "insurance", "model_version": "1"})
    status = {r.batch_id: (r.status, r.diagnosis_code, r.n_rows) for r in run.monitored.status.collect()}
    assert status == {"prod1": ("OK", "HEALTHY", 800), "prod2": ("ALERT", "LABEL_DATA_QUALITY", 800),
                      "prod3": ("ALERT", "FEATURES_BROKEN_UNVERIFIABLE", 800)}
    write_run(run, str(tmp_path / "out"), "r1", 1)
    stored = spark.read.parquet(str(tmp_path / "out" / "predictions"))
    assert stored.count() == 2400 and stored.where("prediction IS NULL").isEmpty()
    with pytest.raises(RuntimeError):
        fail_on_alert(run)

    # the label defect is repaired before the next run
    fixed = str(tmp_path / "prod-next")
    put(people(spark, 800, 32), fixed, "prod2", 1)
    again = score_directory(spark, fixed, trained.winner.model, baseline, INSURANCE, "m1",
                            load_state(spark, str(tmp_path / "out" / "alerts"), 1), "r2", NOW + timedelta(days=1), n_features=14)
    assert {r.transition for r in again.alerts.transitions.collect()} == {"RESOLVED"}
    assert {r.batch_id for r in again.alerts.state.where("state = 'open'").collect()} == {"prod3"}
    assert again.summary.first().overall_status == "OK"


def test_promotion_dry_run(spark):
    versions = spark.createDataFrame([("m", 1, "a", "f", "Production"), ("m", 2, "b", "f", "Staging")],
                                     "model string, version bigint, run_id string, family string, stage string")
    runs = spark.createDataFrame([("a", 100.0, 0.8, 0.01), ("b", 90.0, 0.85, 0.02)],
                                 "run_id string, val_rmse double, val_r2 double, overfitting_r2_diff double")
    aliases = spark.createDataFrame([("m", "production", 1)], "model string, alias string, version bigint")
    dry = promote(Ledger(versions, aliases), runs, NOW, dry_run=True)
    assert dry.ledger is None and dry.decisions.first().action == "PROMOTE"
    done = promote(Ledger(versions, aliases), runs, NOW)
    assert [tuple(r) for r in done.ledger.aliases.collect()] == [("m", "production", 2)]
    again = promote(done.ledger, runs, NOW)
    assert again.decisions.first().action == "NOOP"
