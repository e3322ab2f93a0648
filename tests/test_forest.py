"""Forests on blocks of codes, against a plain version and the ML library's trainer."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hedonic.models import boosting, encode, estimators, forest, sweep
from hedonic.models.boosting import Layout

WIDTHS = [4]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    n = 600
    numbers, slots = np.c_[rng.integers(0, 9, n), rng.normal(0, 1, n).round(1)], rng.integers(0, 5, n)
    y = 3 + numbers[:, 0] * 0.3 + np.sin(numbers[:, 1] * 2) + (slots == 2) + rng.normal(0, 0.1, n)
    return np.c_[numbers, np.eye(5)[slots][:, :4]], y


@pytest.fixture(scope="module")
def vectors(spark, rows):
    x, y = rows
    data = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "i int, a array<double>, label double").repartition(3, "i").select("i", array_to_vector("a").alias("features"), "label").persist()


@pytest.fixture(scope="module")
def binned(rows, vectors):
    x, _ = rows
    layout = Layout([np.unique(x[:, p])[:-1] for p in range(2)], WIDTHS)
    return layout, boosting.bin_rows(vectors, layout)


def plain(x, y, depth, least):
    """The greedy tree that lowers the variance the most."""
    out = np.zeros(len(y))

    def grow(rows, depth):
        mean = y[rows].mean()
        best = (1e-9, None, None)
        for p in range(x.shape[1]) if depth else ():
            for cut in np.unique(x[rows, p])[:-1]:
                left = x[rows, p] <= cut
                n = left.sum()
                if min(n, len(rows) - n) < least:
                    continue
                gain = y[rows].var() - (n * y[rows[left]].var() + (len(rows) - n) * y[rows[~left]].var()) / len(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, p, cut)
        if best[1] is None:
            out[rows] = mean
            return
        left = x[rows, best[1]] <= best[2]
        grow(rows[left], depth - 1), grow(rows[~left], depth - 1)

    grow(np.arange(len(y)), depth)
    return out


def predicted(model, vectors):
    return np.array([r["prediction"] for r in model.transform(vectors).orderBy("i").collect()])


@pytest.mark.parametrize("sums", [1, 1 << 20])
def test_a_tree_of_all_rows_equals_the_plain_one(spark, rows, vectors, binned, sums, monkeypatch):
    monkeypatch.setattr(forest, "SUMS", sums)  # a node at a time, or a level
    x, y = rows
    estimator = estimators.make_estimator("rf", {"n_estimators": 1, "max_depth": 3, "min_samples_leaf": 5, "bootstrap": False})
    model, ratio = forest.fit(spark, estimator, *binned, True)
    want = plain(x, y, 3, 5)
    assert np.allclose(predicted(model, vectors), want, atol=1e-5)
    assert ratio == pytest.approx(np.exp(y - want).mean(), rel=1e-5)
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0) and model.getMinInstancesPerNode() == 5


def test_draws_and_subsets(spark, rows, vectors, binned):
    x, y = rows
    estimator = estimators.make_estimator("rf", {"n_estimators": 12, "max_depth": 5, "max_features": "onethird", "random_state": 3})
    trees = forest.grow(binned[1], binned[0], forest.ForestParams.of(estimator))
    assert len({t.count[0] for t in trees}) > 1 and sum(t.count[0] for t in trees) / 12 == pytest.approx(600, rel=0.05)
    assert all(t.value[0] == pytest.approx(y.mean(), abs=0.2) for t in trees) and len({t.cell[0] for t in trees}) > 1
    ours = forest.as_forest(spark, trees, binned[0], estimator)
    theirs = estimator.fit(vectors.select("features", "label"))
    assert ours.getNumTrees == theirs.getNumTrees == 12
    errors = [((predicted(m, vectors) - y) ** 2).mean() for m in (ours, theirs)]
    assert errors[0] < 1.5 * errors[1]
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.15)


@pytest.mark.parametrize("strategy, asked", [("all", 90), ("auto", 30), ("sqrt", 10), ("log2", 7), ("0.5", 45), ("4", 4)])
def test_positions_of_a_node(strategy, asked):
    assert forest.ForestParams(2, 5, 1, 0.0, 1.0, True, strategy, 0).positions(90) == asked


def test_many_rows_are_fitted_on_blocks(spark, monkeypatch, tmp_path):
    df = spark.createDataFrame([(float(i % 20), "abcd"[i % 4], 100.0 + i % 20) for i in range(400)], "x double, c string, price double")
    params, given = {"n_estimators": 3, "max_depth": 4}, (["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    kept = []
    monkeypatch.setattr(encode, "DENSE_NUMBERS", 1000)
    monkeypatch.setattr("pyspark.sql.DataFrame.persist", lambda self, *_: kept.append(1) or self)
    model = sweep.refit(df, "rf", params, *given)
    assert not kept  # neither vectors nor dense rows are kept
    assert model.importances(spark).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    out = model.predict(df).agg(F.avg(F.abs(F.col("price") - F.col("pred_model")))).first()[0]
    assert out < 2.5
    model.save(f"{tmp_path}/m")
    again = estimators.PriceModel.load(spark, f"{tmp_path}/m")
    assert again.predict(df).agg(F.avg(F.abs(F.col("price") - F.col("pred_model")))).first()[0] == pytest.approx(out)


def test_no_vectors_are_kept_for_ridge_and_boosted(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 20), "abcd"[i % 4], 100.0 + i % 20) for i in range(200)], "x double, c string, price double")
    kept = []
    monkeypatch.setattr("pyspark.sql.DataFrame.persist", lambda self, *_: kept.append(1) or self)
    encoder = encode.fit_encoder(df, ["x"], ["c"], {})
    trials = sweep.sweep(df, df, encoder, {"ridge": [{"alpha": 1.0}], "boosted": [{"n_estimators": 2, "max_depth": 2}]})
    assert len(trials) == 2 and trials[0].scores["R2"] > 0.9
    assert sweep.refit(df, "ridge", {"alpha": 1.0}, ["x"], ["c"], {}).predict(df).count() == 200 and not kept


def test_rows_without_a_label_are_an_error(spark, vectors, binned):
    layout = binned[0]
    blocks = boosting.bin_rows(vectors.withColumn("label", F.when(F.col("i") != 7, F.col("label"))), layout)
    with pytest.raises(ValueError, match="labels"):
        forest.grow(blocks, layout, forest.ForestParams.of(estimators.make_estimator("rf", {"n_estimators": 2})))
    with pytest.raises(ValueError, match="rows"):
        forest.grow(blocks.limit(0), layout, forest.ForestParams.of(estimators.make_estimator("rf", {"n_estimators": 2})))
