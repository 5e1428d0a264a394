from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import NOW, people
from pyspark.sql import functions as F

from tidewatch.operators import alerts as A
from tidewatch.operators import eda, ledger, selection, training
from tidewatch.operators.features import category_codes, category_levels, derive_features, encoded_names, one_hot
from tidewatch.operators.report import transition_counts
from tidewatch.operators.rules import flatten_rules, load_rules, resolve_thresholds
from tidewatch.operators.shaping import to_series
from tidewatch.sources.tables import prepare_training_rows
from tidewatch.spec import INSURANCE

RULES = {
    "features": {"bmi": {"psi_warn": 0.05, "psi_alert": 0.15}, "region": {"psi_warn": 0.2, "psi_alert": 0.4}},
    "batches": {"prod3": {"psi_warn": 0.02, "psi_alert": 0.08, "schema_alert_pct": 5,
                          "features": {"region": {"psi_warn": 0.3, "psi_alert": 0.6}}}},
}


def resolved(spark, batch, feature, rules):
    scope = spark.createDataFrame([(batch, feature)], "batch_id string, feature string")
    return resolve_thresholds(scope, rules, per_feature=True).first()


@pytest.mark.parametrize("batch, feature, warn, alert, origin, source", [
    ("prod1", "age", 0.10, 0.25, "default", "default"),
    ("prod1", "bmi", 0.05, 0.15, "feature:bmi", "feature:bmi"),
    ("prod3", "age", 0.02, 0.08, "batch:prod3", "batch:prod3"),
    ("prod3", "bmi", 0.02, 0.08, "batch:prod3", "feature:bmi+batch:prod3"),
    ("prod3", "region", 0.3, 0.6, "batch:prod3/feature:region", "feature:region+batch:prod3+batch:prod3/feature:region"),
])
def test_rule_precedence(spark, batch, feature, warn, alert, origin, source):
    r = resolved(spark, batch, feature, RULES)
    assert (r.psi_warn, r.psi_alert, r.sources["psi"], r.source) == (warn, alert, origin, source)
    assert r.sources["perf"] == "default" and r.perf_warn_ratio == 1.25


def test_origin_is_kept_per_group(spark):
    rules = {"features": {"bmi": {"psi_warn": 0.01}}, "batches": {"prod3": {"schema_warn_pct": 3}}}
    r = resolved(spark, "prod3", "bmi", rules)
    assert (r.sources["psi"], r.sources["schema"], r.sources["r2"]) == ("feature:bmi", "batch:prod3", "default")
    # one field of the pair from the batch rule is enough to name it, the other field stays
    half = resolved(spark, "prod3", "bmi", {"features": {"bmi": {"psi_warn": 0.01, "psi_alert": 0.5}},
                                            "batches": {"prod3": {"psi_alert": 0.9}}})
    assert (half.psi_warn, half.psi_alert, half.sources["psi"]) == (0.01, 0.9, "batch:prod3")


@pytest.mark.parametrize("rules", [None, [], {}, {"batches": {"prod3": 0.05}}, {"features": "x"}, {"features": {"bmi": {"psi_warn": "?"}}},
                                   {"features": {"bmi": {"unknown": 1}}}])
def test_malformed_rules_fall_back(spark, rules):
    assert flatten_rules(rules) == []
    assert resolved(spark, "prod3", "bmi", rules).source == "default"


def test_rules_file(tmp_path):
    assert load_rules(tmp_path / "absent.json") == {}
    (tmp_path / "broken.json").write_text("{")
    (tmp_path / "list.json").write_text("[1]")
    (tmp_path / "good.json").write_text('{"features": {"bmi": {"psi_warn": "0.07"}}}')
    assert load_rules(tmp_path / "broken.json") == {} and load_rules(tmp_path / "list.json") == {}
    assert flatten_rules(load_rules(tmp_path / "good.json")) == [(None, "bmi", "feature:bmi", {"psi_warn": 0.07})]


SIGNALS = "batch_id string, seq int, name string, category string, value double, status string, detail string, thresholds_source string"


def step(spark, state, day, signals, batches=("p",)):
    rows = spark.createDataFrame([(b, i, n, "feature_drift", float("nan"), s, f"day {day}", "default")
                                  for i, (b, n, s) in enumerate(signals)], SIGNALS)
    runs = spark.createDataFrame([(b,) for b in batches], "batch_id string")
    out = A.reconcile(state, rows, runs, f"r{day}", NOW + timedelta(days=day), "m")
    moves = {(t.batch_id, t.signal_name): t for t in out.transitions.collect()}
    return spark.createDataFrame(out.state.collect(), A.STATE_SCHEMA), moves, out


def test_replay_equals_run_by_run(spark):
    days = [[("p", "a", "WARNING"), ("p", "b", "OK"), ("q", "z", "ALERT")], [("p", "a", "ALERT"), ("p", "b", "WARNING")],
            [("p", "b", "ALERT"), ("q", "z", "OK")], [("p", "a", "WARNING"), ("p", "b", "WARNING"), ("q", "y", "OK")], [("p", "a", "OK"), ("p", "c", "OK")]]
    state, transitions, closed, history = A.empty_state(spark), [], [], None
    for day, signals in enumerate(days):
        state, moves, out = step(spark, state, day, signals, sorted({b for b, _, _ in signals}))
        transitions += moves.values()
        closed += out.closed.collect()
        rows = spark.createDataFrame([(b, i, n, "feature_drift", 1.0, s, f"day {day}", "default", day, f"r{day}", NOW + timedelta(days=day))
                                      for i, (b, n, s) in enumerate(signals)], SIGNALS + ", run int, run_id string, at timestamp_ntz")
        history = rows if history is None else history.unionByName(rows)
    again = A.replay(history.drop("nothing"), "m")
    names = ["run_id", "batch_id", "signal_name", "category", "severity", "transition", "occurrences", "first_seen", "last_seen",
             "detail", "thresholds_source", "escalated_from"]
    assert {tuple(r[n] for n in names) for r in again.transitions.collect()} == {tuple(t[n] for n in names) for t in transitions}
    kept = [c for c in state.columns if c not in ("last_value", "severity_history")]
    for whole, parts in ((again.state, state.collect()), (again.closed, closed)):
        assert {(tuple(r[c] for c in kept), tuple(map(tuple, r.severity_history))) for r in whole.collect()} == {
            (tuple(r[c] for c in kept), tuple(map(tuple, r.severity_history))) for r in parts}


def test_alert_life_cycle(spark):
    state, moves, _ = step(spark, A.empty_state(spark), 0, [("p", "a", "WARNING"), ("p", "b", "OK"), ("q", "z", "ALERT")], ("p", "q"))
    assert {k: v.transition for k, v in moves.items()} == {("p", "a"): "NEW", ("q", "z"): "NEW"}
    state, moves, _ = step(spark, state, 1, [("p", "a", "ALERT"), ("p", "b", "WARNING"), ("p", "b", "ALERT")])
    assert (moves["p", "a"].transition, moves["p", "a"].escalated_from, moves["p", "a"].occurrences) == ("ONGOING", "WARNING", 2)
    assert (moves["p", "b"].transition, moves["p", "b"].severity) == ("NEW", "ALERT")  # the last one wins
    assert ("q", "z") not in moves  # not in this run: neither resolved nor touched
    state, moves, out = step(spark, state, 2, [("p", "b", "ALERT")])  # a is absent
    closed = out.closed.collect()
    assert (moves["p", "a"].transition, moves["p", "a"].last_seen) == ("RESOLVED", NOW + timedelta(days=1))
    assert (moves["p", "b"].transition, moves["p", "b"].escalated_from) == ("ONGOING", None)
    status = spark.createDataFrame([("p", True), ("q", False), ("quiet", True)], "batch_id string, reconciled boolean")
    counts = {r.batch_id: (r.new, r.ongoing, r.resolved) for r in transition_counts(out.transitions, status).collect()}
    assert counts == {"p": (0, 1, 1), "q": (None, None, None), "quiet": (0, 0, 0)}
    state, moves, _ = step(spark, state, 3, [("p", "a", "WARNING"), ("p", "b", "WARNING")])
    assert (moves["p", "a"].transition, moves["p", "a"].occurrences) == ("NEW", 1)  # a resolved one that fails again
    rows = {(r.batch_id, r.signal_name, r.state): r for r in state.collect()}
    assert len(rows) == 3 and A.duplicate_open_alerts(state).isEmpty()
    assert [h.severity for h in rows["p", "b", "open"].severity_history] == ["ALERT", "WARNING"]
    assert [(r.signal_name, r.state, r.resolved_at) for r in closed] == [("a", "resolved", NOW + timedelta(days=2))] and rows["p", "a", "open"].last_value is None
    assert {(r.batch_id, r.signal_name) for r in A.open_alerts(state).collect()} == {("p", "a"), ("p", "b"), ("q", "z")}
    assert A.recent_history(state, 1, "p", include_resolved=True).count() == 1


def candidates(spark, rows):
    return spark.createDataFrame([("all", *r) for r in rows],
                                 "c string, family string, catalog_order int, val_rmse double, val_r2 double, cv_rmse_log double")


def test_selection(spark):
    tie = candidates(spark, [("late", 2, 4900.0, 0.8, 0.5), ("early", 1, 4900.0, 0.7, 0.4)])
    best = selection.select_best(tie, ["c"]).first()
    assert (best.winner, best.runner_up, best.rankings_disagree) == ("early", "late", False)
    split = candidates(spark, [("a", 1, 5000.0, 0.9, 0.1), ("b", 2, 4000.0, 0.8, 0.3), ("elasticnet", 3, 6000.0, 0.5, 0.9)])
    best = selection.select_best(split, ["c"]).first()
    assert (best.winner, best.cv_winner, best.rankings_disagree) == ("b", "a", True)
    assert selection.select_best(split, ["c"], "val_r2", "max").first().winner == "a"
    assert [r.delta_to_linear for r in selection.comparison_table(split, ["c"]).collect()] == [2000.0, 1000.0, 0.0]
    for bad in ("rmse", "val_nothing", "train_r2"):
        with pytest.raises(KeyError):
            selection.select_best(split, ["c"], bad)


def test_promotion_gates(spark):
    schema = "model string, version bigint, val_rmse double, val_r2 double, overfitting_r2_diff double"
    rows = spark.createDataFrame([
        ("good", 2, 90.0, 0.8, 0.05), ("edge", 2, 100.0, 0.75, 0.1499), ("weak", 2, 90.0, 0.74, 0.05), ("over", 2, 90.0, 0.8, 0.15),
        ("worse", 2, 101.0, 0.8, 0.05), ("blank", 2, None, None, None), ("first", 1, 500.0, 0.9, None), ("same", 1, 999.0, 0.1, 0.9)], schema)
    production = spark.createDataFrame([(m, 1, 100.0) for m in ("good", "edge", "weak", "over", "worse", "blank", "same")],
                                       "model string, version bigint, val_rmse double")
    decided = ledger.promotion_decisions(rows, production)
    assert {r.model: r.action for r in decided.collect()} == {
        "good": "PROMOTE", "edge": "PROMOTE", "weak": "REJECT", "over": "REJECT", "worse": "REJECT", "blank": "REJECT",
        "first": "PROMOTE", "same": "NOOP"}
    stricter = ledger.promotion_decisions(rows, production, min_improvement=0.05)
    assert {r.model for r in stricter.where("action = 'PROMOTE'").collect()} == {"good", "first"}
    versions = spark.createDataFrame([("good", 1, "Production"), ("good", 2, "Staging"), ("weak", 2, "Staging")],
                                     "model string, version bigint, stage string")
    aliases = spark.createDataFrame([("good", "production", 1), ("good", "staging", 2), ("weak", "staging", 2)],
                                    "model string, alias string, version bigint")
    after = ledger.apply_promotions(ledger.Ledger(versions, aliases), decided.where("model IN ('good', 'weak')"), NOW)
    assert {tuple(r) for r in after.aliases.collect()} == {("good", "production", 2), ("weak", "staging", 2)}
    assert {(r.model, r.version, r.stage, r.superseded_by) for r in after.versions.collect()} == {
        ("good", 1, "Archived", 2), ("good", 2, "Production", None), ("weak", 2, "Staging", None)}


def test_latest_version_is_a_number_and_families_default(spark):
    versions = spark.createDataFrame([("m", "9", "x", 1.0), ("m", "10", None, 2.0)], "model string, version string, family string, rmse double")
    assert ledger.latest_versions(versions).first().version == "10"
    asked = spark.createDataFrame([("m", None, 2.0000000001), ("m", "x", 2.0), ("m", None, 2.1)], "model string, family string, rmse double")
    assert [r.rmse for r in ledger.duplicate_versions(asked, versions, ("rmse",)).collect()] == [2.0000000001]


def test_derived_features(spark):
    rows = spark.createDataFrame([(50.0, 29.99, "yes"), (51.0, 30.0, "no"), (20.0, 30.01, None), (None, None, "yes")],
                                 "age double, bmi double, smoker string")
    got = derive_features(rows, INSURANCE.derived).collect()
    assert [(r.bmi_obese, r.age_senior) for r in got] == [(0, 0), (0, 1), (1, 0), (0, 0)]
    assert [r.bmi_smoker for r in got] == [29.99, 0.0, 0.0, None] and got[0].age_squared == 2500.0


def test_one_hot_width_and_unknown_level(spark):
    levels = category_levels(people(spark, 500, 1), INSURANCE.categorical)
    assert len(encoded_names(INSURANCE, levels)) == 14
    odd = spark.createDataFrame([("other", "yes", "mars")], "sex string, smoker string, region string")
    row = odd.select(*[e.alias(n) for n, e in one_hot(levels).items()]).first().asDict()
    assert row == {"sex_male": 0, "smoker_yes": 1, "region_northwest": 0, "region_southeast": 0, "region_southwest": 0}


def test_category_codes(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "c", "a", "b", None]], "x string")
    assert {(r.x, r.x_code) for r in category_codes(df, "x").collect()} == {("a", 0), ("b", 1), ("c", 2), (None, None)}


def test_exploration_against_pandas(spark):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame({"a": rng.gamma(2, 3, 400).round(2), "b": rng.normal(0, 1, 400).round(3), "g": rng.choice(list("xyz"), 400)})
    frame["c"] = frame.a * 2 + frame.b
    frame.loc[::17, "b"] = np.nan
    df = spark.createDataFrame(frame).withColumn("b", F.nullif("b", F.lit(float("nan"))))
    corr = {(r.left, r.right): r.corr for r in eda.correlations(df, ["a", "b", "c"]).collect()}
    expected = frame[["a", "b", "c"]].corr()
    assert all(np.isclose(corr[x, y], expected.loc[x, y]) for x in "abc" for y in "abc")
    moments = {r.series: r for r in eda.moments(to_series(df, [], ["a", "b"])).collect()}
    for c in "ab":
        assert np.allclose([moments[c].skewness, moments[c].kurtosis, moments[c].median, moments[c].std],
                           [frame[c].skew(), frame[c].kurtosis(), frame[c].median(), frame[c].std()])
    groups = frame.groupby("g")["a"].agg(["count", "mean", "median", "std", "min", "max"])
    for r in eda.group_statistics(df, ["g"], "a").collect():
        assert np.allclose([r.n, r["mean"], r["median"], r["std"], r["min"], r["max"]], groups.loc[r.g].values)
    counts, edges = np.histogram(frame.a, bins=13)
    bars = eda.histogram(to_series(df, [], ["a"]), 13).orderBy("bin").collect()
    assert sum(r.n for r in bars) == 400 and len(bars) == 13 and np.abs(np.array([r.n for r in bars]) - counts).sum() <= 2
    assert np.allclose([r.low for r in bars], edges[:-1])


def test_all_copies_are_kept_whole(spark):
    rows = [("hot", 1.0)] * 50 + [("twice", None)] * 2 + [("once", 2.0)]
    got = eda.all_copies(spark.createDataFrame(rows, "k string, v double").repartition(4)).collect()
    assert sorted((r.k, r.n_copies) for r in got) == [("hot", 50)] * 50 + [("twice", 2)] * 2


def test_training_rows(spark):
    raw = people(spark, 100, 3).drop("row_index").withColumn("extra", F.lit("e"))
    both = raw.unionByName(raw)
    assert prepare_training_rows(both, INSURANCE).count() == raw.distinct().count()
    with pytest.raises(ValueError):
        prepare_training_rows(raw.drop("bmi"), INSURANCE)


def test_catalogue():
    assert [f.name for f in training.requested(["elasticnet", "gradient_boosting"])] == ["gradient_boosting", "elasticnet"]
    for names in (["nothing"], []):
        with pytest.raises(ValueError):
            training.requested(names)
    plans = [training.trial_plan(f, 50) for f in training.requested()]
    assert [(len(points), size) for points, size in plans] == [(50, 64), (20, 144), (20, 108), (20, 20)]
    linear, forest = training.CATALOG["elasticnet"], training.CATALOG["random_forest"]
    assert len(training.trial_plan(linear, 500)[0]) == 20 and len(training.trial_plan(linear, 0)[0]) == 1
    drawn, _ = training.trial_plan(forest, 50)
    assert len({tuple(d.items()) for d in drawn}) == 20 and drawn == training.trial_plan(forest, 50)[0]


def test_search_saves_a_model_that_scores_batches(spark, tmp_path):
    rows = training.split_rows(people(spark, 600, 5), ["row_index"]).cache()
    train = rows.where("split = 'train'")
    levels = category_levels(train, INSURANCE.categorical)
    family = training.Family("elasticnet", "Elastic net", training.LinearRegression, {"standardization": False},
                             {"regParam": [0.001, 10.0], "elasticNetParam": [0.5]}, scaled=True, importance="abs_coef")
    found = training.search_family(train, family, INSURANCE, levels, ["row_index"], budget=5, folds=3)
    assert found.best_params["regParam"] == 0.001 and len(found.trials) == 2
    assert all(t["mean_train_rmse"] is not None for t in found.trials)
    ranked = selection.top_trials(training.trials_table(spark, [found]), 1).first()
    assert ranked["rank"] == 1 and ranked.params == '{"elasticNetParam": 0.5, "regParam": 0.001}'
    table = training.candidates_table([found], rows, INSURANCE, 14, 5)
    row = table.first()
    assert row.val_r2 > 0.5 and row.overfitting_band in ("none", "minor", "moderate", "severe") and row.n_iter == 2
    names = encoded_names(INSURANCE, levels)
    importance = training.feature_importance(found.model, family, names)
    assert importance.kind == "abs_coef" and len(importance.values) == 14
    found.model.save(str(tmp_path / "model"))
    again = training.PipelineModel.load(str(tmp_path / "model"))
    batch = people(spark, 50, 77).drop("charges")
    a = training.predict(found.model, batch, INSURANCE).orderBy("row_index").collect()
    b = training.predict(again, batch, INSURANCE).orderBy("row_index").collect()
    assert [r.prediction for r in a] == [r.prediction for r in b] and all(r.prediction > 0 for r in a)
