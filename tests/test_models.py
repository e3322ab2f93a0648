import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hedonic.models import encode, estimators, sweep
from hedonic.models.boosting import BoostParams
from hedonic.models.estimators import PriceModel, fit_encoded
from hedonic.operators.split import by_year
from hedonic.sinks.runs import RunStore

SCHEMA = "k int, x double, z double, c string, price double, sold_date timestamp_ntz"


@pytest.fixture(scope="module")
def homes(spark):
    from datetime import datetime

    rnd = random.Random(11)
    rows = []
    for i in range(600):
        x, z, c = rnd.uniform(0, 10), rnd.uniform(-1, 1), rnd.choice("aaabbbc")
        price = 1000 * np.exp(0.2 * x + 0.3 * z + {"a": 0.0, "b": 0.5, "c": 1.0}[c] + rnd.gauss(0, 0.1))
        rows.append((i, x if i % 50 else None, z, c if i % 40 else None, float(price), datetime(2000 + i % 4, 3, 1)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "k").persist()


def labels_of(encoder, column="c"):
    return [r["bucket"] for r in encoder.slot_table(column).orderBy("slot").collect()]


def dense(df):
    return np.array([r[0] for r in df.select(vector_to_array("features")).collect()])


@pytest.mark.parametrize("alpha", [0.5, 7.0, 50.0])
def test_ridge_equals_the_closed_form(homes, alpha):
    encoder = encode.fit_encoder(homes, ["x", "z"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    model = fit_encoded("ridge", {"alpha": alpha}, encoder.transform(homes), encoder)
    rows = encoder.transform(homes).select(vector_to_array("features").alias("f"), "price").collect()
    x, y = np.array([r["f"] for r in rows]), np.log1p([r["price"] for r in rows])
    xc = x - x.mean(axis=0)
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    assert np.allclose(model.regressor.coefficients.toArray(), want, rtol=1e-6, atol=1e-8)
    assert model.smear > 0


def test_filling_scaling_and_unknown_categories(spark, homes):
    encoder = encode.fit_encoder(homes, ["x", "z"], ["c"], {"preprocess": {"scaler": "standard", "one_hot": {"min_frequency": 120}}})
    assert labels_of(encoder) == sorted([encode.INFREQUENT, "a", "b"])
    numbers = dense(encoder.transform(homes))[:, :2]
    assert np.allclose(numbers.mean(axis=0), 0, atol=1e-9) and np.allclose(numbers.std(axis=0), 1, atol=1e-9)
    late = spark.createDataFrame([(1, None, 0.0, c, 1.0, None) for c in ("a", "c", "never seen", None)], SCHEMA)
    hot = {r["c"]: list(r["f"])[2:] for r in encoder.transform(late).select("c", vector_to_array("features").alias("f")).collect()}
    labels = labels_of(encoder)
    assert hot["never seen"] == [0.0, 0.0, 0.0]
    assert hot["a"][labels.index("a")] == 1.0 and hot["c"][labels.index(encode.INFREQUENT)] == 1.0
    assert hot[None] == [1.0 if name == encoder.categorical_fill["c"] else 0.0 for name in labels]


def test_minimum_frequency_as_a_share(homes):
    encoder = encode.fit_encoder(homes, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 0.3}}})
    assert labels_of(encoder) == sorted([encode.INFREQUENT, "a", "b"])
    assert labels_of(encode.fit_encoder(homes, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 0.01}}})) == ["a", "b", "c"]


def test_very_many_categories(spark):
    many = spark.range(200_000).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("x"))
    encoder = encode.fit_encoder(many, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    assert len(encoder.slots) == 200_001
    few = encoder.transform(many.filter("c IN ('0', '199999')")).collect()
    places = {r["c"]: set(r["features"].indices.tolist()) for r in few}
    # slots follow the order of the texts: '0' is the first, and '199999' stands behind '199998'
    assert 1 in places["0"] and not places["0"] & (places["199999"] - {0})


def test_ridge_solvers_agree_and_tell_when_they_do_not_converge(homes):
    encoder = encode.fit_encoder(homes, ["x", "z"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    vectors = encoder.transform(homes)
    exact, steps = (fit_encoded("ridge", {"alpha": 7.0, "solver": s}, vectors, encoder) for s in ("normal", "l-bfgs"))
    assert np.allclose(exact.regressor.coefficients.toArray(), steps.regressor.coefficients.toArray(), rtol=1e-3, atol=1e-4)
    with pytest.raises(RuntimeError, match="did not converge"):
        fit_encoded("ridge", {"alpha": 7.0, "solver": "l-bfgs", "max_iter": 1}, vectors, encoder)
    with pytest.raises(ValueError, match="solver"):
        fit_encoded("ridge", {"solver": "guess"}, vectors, encoder)


def test_what_the_trainer_cannot_follow_is_reported():
    given = {"max_depth": 40, "early_stopping": 10, "n_estimators": 3, "n_jobs": 1}
    assert estimators.without_counterpart("rf", given) == {"max_depth": 40, "early_stopping": 10}
    assert estimators.without_counterpart("rf", {"max_depth": 30}) == {}
    assert estimators.distinct_candidates("rf", [{"max_depth": None}, {"max_depth": 40}, {"max_depth": 20}]) == [{"max_depth": None}, {"max_depth": 20}]
    for share, want in ((None, "all"), (1.0, "all"), (1, "1"), (0.5, "0.5"), ("sqrt", "sqrt")):
        assert estimators.make_estimator("rf", {"max_features": share}).getFeatureSubsetStrategy() == want


@pytest.mark.parametrize("family,params", [("rf", {"n_estimators": 5, "max_depth": 5, "random_state": 0}), ("boosted", {"n_estimators": 5, "max_depth": 3})])
def test_trees_beat_the_mean_and_their_importances_add_up(spark, homes, family, params):
    encoder = encode.fit_encoder(homes, ["x", "z"], ["c"])
    model = fit_encoded(family, params, encoder.transform(homes), encoder)
    assert sweep.score(model.predict(homes))["R2"] > 0.3
    found = {r["group"]: r["importance"] for r in model.importances(spark).collect()}
    assert set(found) == {"x", "z", "c"} and sum(found.values()) == pytest.approx(1.0)


def test_saved_models_predict_the_same(spark, homes, tmp_path):
    settings = {"preprocess": {"scaler": "standard"}}
    model = sweep.refit(homes, "ridge", {"alpha": 1.0}, ["x", "z"], ["c"], settings)
    model.save(str(tmp_path / "m"))
    again = PriceModel.load(spark, str(tmp_path / "m"))
    a = {r["k"]: r["pred_model"] for r in model.predict(homes).collect()}
    assert a == pytest.approx({r["k"]: r["pred_model"] for r in again.predict(homes).collect()})
    assert again.importances(spark) is None


def test_registry():
    assert [estimators.resolve_kind(k) for k in ("auto", "XGBoost", "random_forest", "ridge")] == ["boosted", "boosted", "rf", "ridge"]
    assert estimators.resolve_kind("auto", {"model": {"xgboost": {"enabled": False}}}) == "rf"
    with pytest.raises(ValueError):
        estimators.resolve_kind("svm")


def test_parameters_are_translated_or_reported(spark):
    forest = estimators.make_estimator("rf", {"n_estimators": 7, "max_depth": None, "max_features": "sqrt", "min_samples_leaf": 2})
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy(), forest.getMinInstancesPerNode()) == (7, 30, "sqrt", 2)
    trees = BoostParams.of({"n_estimators": 9, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.7, "n_jobs": -1, "reg_lambda": 2, "max_depth": None})
    assert (trees.rounds, trees.rate, trees.subsample, trees.columns, trees.l2, trees.depth) == (9, 0.05, 0.8, 0.7, 2.0, 6)
    assert estimators.without_counterpart("boosted", {"reg_lambda": 1.0, "max_depth": 40, "n_jobs": 4, "early_stopping": 3}) == {"early_stopping": 3}


def trials(spark, rows):
    return spark.createDataFrame(rows, "trial_no int, family string, MAE double, RMSE double, R2 double")


def test_selection_rules(spark):
    t = trials(spark, [(0, "ridge", 5.0, 10.0, 0.5), (1, "ridge", 5.0, 9.0, 0.5), (2, "rf", 4.0, 9.0, 0.5), (3, "rf", 4.0, 9.5, None)])
    assert {r["family"]: r["trial_no"] for r in sweep.best_per_family(t).collect()} == {"ridge": 0, "rf": 2}
    assert sweep.best_overall(t).first()["trial_no"] == 0
    assert sweep.best_by_rmse(t).first()["trial_no"] == 2
    near = trials(spark, [(0, "a", 5.0, 100.0, 0.1), (1, "a", 4.0, 100.0005, 0.1), (2, "a", 3.0, 101.0, 0.1)])
    assert sweep.best_by_rmse(near).first()["trial_no"] == 1
    assert sweep.expand_grid({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]


def test_runs_replace_only_themselves(spark, tmp_path):
    for run_id, n in (("2025-01-01_000000", 3), ("2025-01-02_000000", 4), ("2025-01-01_000000", 5)):
        store = RunStore(spark, str(tmp_path / "runs"), run_id)
        assert store.write("t", spark.range(n)).count() == n
    assert {r["run_id"]: r["count"] for r in store.read("t").groupBy("run_id").count().collect()} == {"2025-01-01_000000": 5, "2025-01-02_000000": 4}
    assert store.latest("t").count() == 4


def test_run_without_dates_splits_by_hash(spark, homes, tmp_path):
    settings = {"features": {"numeric": ["x", "z"], "categorical": ["c"], "engineered": []}}
    out = sweep.run_single(homes.drop("sold_date"), settings, RunStore(spark, str(tmp_path / "r"), "one"), "k", "ridge", {"alpha": 1.0})
    found = {(r["family"], r["metric"]): r["value"] for r in out["metrics"].collect()}
    assert found["model", "MAE"] < found["baseline", "MAE"]


def test_sweep_with_downsampling_writes_all_outputs(spark, homes, tmp_path):
    settings = {
        "split": {"train_max_year": 2001, "val_year": 2002, "test_min_year": 2003},
        "features": {"numeric": ["x", "z", "year"], "categorical": ["c"], "engineered": []},
        "run": {"max_train_rows": 100},
        "eval": {"slices": {"group_cols": ["c"], "min_count": 1}},
    }
    store = RunStore(spark, str(tmp_path / "s"), "one")
    out = sweep.run_sweep(homes, settings, store, "k", {"ridge": [{"alpha": 1.0}], "rf": [{"n_estimators": 3, "max_depth": 3}]})
    assert out["summary"].count() == 6 and out["trials"].count() == 2
    assert out["gate"].first()["model_beats_baseline"]
    assert {r["split"] for r in out["overview"].collect()} == {"train", "val", "test"}
    test = by_year(homes, 2001, 2002, 2003).filter(F.col("split") == "test").count()
    assert out["predictions"].count() == test
