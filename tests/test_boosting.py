"""Histogram boosting against a plain version, in one task and in many, and one fit for several numbers of trees."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hedonic.models import boosting, encode, estimators, sweep
from hedonic.models.boosting import BoostParams, Layout

WIDTHS = [5, 3]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 900
    numbers = np.c_[rng.integers(0, 7, n), rng.normal(0, 1, n).round(1), np.full(n, 2.0)]
    slots = np.c_[rng.integers(0, 6, n), rng.integers(0, 4, n)]  # the last slot is an unknown category
    y = numbers[:, 0] * 0.3 + np.sin(numbers[:, 1] * 2) + (slots[:, 0] == 2) + rng.normal(0, 0.1, n)
    hot = np.concatenate([np.eye(w + 1)[slots[:, k]][:, :w] for k, w in enumerate(WIDTHS)], axis=1)
    return np.c_[numbers, hot], y


@pytest.fixture(scope="module")
def vectors(spark, rows):
    x, y = rows
    data = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "i int, a array<double>, label double").repartition(3, "i")
    return df.select("i", array_to_vector("a").alias("features"), "label").persist()


def plain(x, y, params: BoostParams):
    """Exact greedy boosting: every value of every position is tried as a cut."""

    def score(g, h):
        return (np.sign(g) * max(abs(g) - params.l1, 0)) ** 2 / (h + params.l2)

    def tree(rows, g, depth):
        total, n = g[rows].sum(), len(rows)
        best = (max(params.gamma, 1e-9), None, None)
        for p in range(x.shape[1]) if depth < params.depth else ():
            for cut in np.unique(x[rows, p])[:-1]:
                left = rows[x[rows, p] <= cut]
                gl, hl = g[left].sum(), len(left)
                if min(hl, n - hl) < params.min_child_weight:
                    continue
                gain = score(gl, hl) + score(total - gl, n - hl) - score(total, n)
                if gain > best[0] + 1e-9:
                    best = (gain, p, cut)
        if best[1] is None:
            out = np.zeros(len(y))
            out[rows] = -params.rate * np.sign(total) * max(abs(total) - params.l1, 0) / (n + params.l2)
            return out
        goes = x[rows, best[1]] <= best[2]
        return tree(rows[goes], g, depth + 1) + tree(rows[~goes], g, depth + 1)

    margin = np.full(len(y), y.mean())
    for _ in range(params.rounds):
        margin = margin + tree(np.arange(len(y)), margin - y, 0)
    return margin


def exact_layout(x):
    return Layout([np.unique(x[:, p])[:-1] for p in range(3)], WIDTHS)


def predicted(model, vectors):
    return np.array([r["prediction"] for r in model.transform(vectors).orderBy("i").collect()])


@pytest.mark.parametrize(
    "params",
    [
        BoostParams(rounds=1, depth=1, rate=1.0, l2=0.0),
        BoostParams(rounds=6, depth=4, rate=0.3),
        BoostParams(rounds=4, depth=5, rate=0.5, l2=3.0, l1=2.0, gamma=0.5, min_child_weight=20),
    ],
)
@pytest.mark.parametrize("task_rows", [1, 1 << 20])
def test_trees_equal_the_plain_version(spark, rows, vectors, params, task_rows, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 3)
    x, y = rows
    layout = exact_layout(x)
    base, trees = boosting.boost(boosting.bin_rows(vectors, layout), layout, params, task_rows)
    model = boosting.as_model(spark, base, trees, layout, params)
    assert np.allclose(predicted(model, vectors), plain(x, y, params), atol=1e-6)
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_samples_are_the_same_in_one_task_and_in_many(rows, vectors):
    x, _ = rows
    layout = exact_layout(x)
    blocks = boosting.bin_rows(vectors, layout)
    params = BoostParams(rounds=4, depth=3, subsample=0.6, columns=0.5, seed=5)
    (a, one), (b, many) = (boosting.boost(blocks, layout, params, rows) for rows in (1 << 20, 1))
    assert a == pytest.approx(b)
    for s, t in zip(one, many):
        assert (s.cell, s.left, s.count) == (t.cell, t.left, t.count) and np.allclose(s.value, t.value)
    positions = [{layout.position[c] for c in t.cell if c >= 0} for t in one]
    assert all(len(p) <= layout.width // 2 for p in positions) and len(set(map(frozenset, positions))) > 1
    assert sum(t.count[0] for t in one) / 4 == pytest.approx(0.6 * 900, rel=0.1)


def test_cut_points_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors

    data = [(Vectors.sparse(4, [0, 3], [float(i % 5), 1.0]) if i % 2 else Vectors.dense([float(i % 5), 0.0, 1.0, 0.0]), float(i)) for i in range(50)]
    df = spark.createDataFrame(data, ["features", "label"])
    layout = boosting.fit_layout(df, 2, [2])
    assert [c.tolist() for c in layout.cuts] == [[0.0, 1.0, 2.0, 3.0], []]
    block = boosting.bin_rows(df.coalesce(1), layout).first()
    codes = [np.frombuffer(c, dtype=np.uint8) for c in block["codes"]]
    assert codes[0].tolist() == [i % 5 for i in range(50)] and codes[2].tolist() == [1 if i % 2 else 0 for i in range(50)]


def test_no_rows_and_equal_labels(spark, vectors):
    layout = Layout([np.array([1.0])] * 3, WIDTHS)
    base, trees = boosting.boost(boosting.bin_rows(vectors.limit(0), layout), layout, BoostParams(rounds=2))
    assert base == 0 and predicted(boosting.as_model(spark, base, trees, layout, BoostParams(rounds=2)), vectors).tolist() == [0.0] * 900
    flat = vectors.withColumn("label", F.lit(4.0))
    base, trees = boosting.boost(boosting.bin_rows(flat, layout), layout, BoostParams(rounds=2))
    assert np.allclose(predicted(boosting.as_model(spark, base, trees, layout, BoostParams(rounds=2)), vectors), 4.0)


def test_one_fit_for_several_numbers_of_trees(spark, monkeypatch):
    rng = np.random.default_rng(1)
    data = [(float(a), "ab"[a % 2], float(np.exp(0.1 * a + rng.normal(0, 0.1)))) for a in rng.integers(0, 20, 400)]
    df = spark.createDataFrame(data, "x double, c string, price double").persist()
    train, val = df.filter("x < 15"), df.filter("x >= 10")
    encoder = encode.fit_encoder(train, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    grid = [{"n_estimators": n, "max_depth": d, "learning_rate": 0.2} for d in (2, 3) for n in (9, 3, 6)]
    fits, boost = [], boosting.boost
    monkeypatch.setattr(boosting, "boost", lambda blocks, layout, params, *rest: fits.append(params.rounds) or boost(blocks, layout, params, *rest))
    together = sweep.sweep(train, val, encoder, {"ridge": [{"alpha": 1.0}], "boosted": grid})
    assert sorted(fits) == [9, 9]
    alone = [sweep.sweep(train, val, encoder, {"boosted": [p]})[0] for p in grid]
    assert len(fits) == 2 + len(grid) and [t.number for t in together] == list(range(7))
    for a, b in zip(together[1:], alone):
        assert a.params == b.params and a.scores == pytest.approx(b.scores) and a.model.smear == pytest.approx(b.model.smear)
        first, second = (m.predict(val).agg(F.sum("pred_model")).first()[0] for m in (a.model, b.model))
        assert first == pytest.approx(second)
    assert together[1].model.regressor.getNumTrees == 9 and together[2].model.regressor.getNumTrees == 3
    assert estimators.fit_encoded("boosted", grid[1], encoder.transform(train), encoder).importances(spark).count() == 2


@pytest.mark.parametrize("task_rows", [1, 1 << 20])
def test_labels_are_compared_in_the_fit_itself(spark, rows, vectors, task_rows):
    x, y = rows
    layout, params = exact_layout(x), BoostParams(rounds=5, depth=3, subsample=0.7)
    base, trees = boosting.boost(boosting.bin_rows(vectors, layout), layout, params, task_rows, [2, 5])
    for n in (2, 5):
        model = boosting.as_model(spark, base, trees[:n], layout, params)
        assert trees.ratios[n] == pytest.approx(np.exp(y - predicted(model, vectors)).mean())
    assert set(trees.ratios) == {2, 5}


def test_sums_of_combined_columns_are_those_of_each_column():
    rng = np.random.default_rng(2)
    n = 3 * boosting.STEP_ROWS
    layout = Layout([np.arange(6.0), np.arange(9.0), np.arange(255.0)], [4, 700])
    codes = [rng.integers(0, size, n).astype(np.uint16) for size in layout.sizes]
    label = rng.normal(10, 3, n)
    work = boosting._Local([boosting.Block(codes, label, np.zeros(0), 0)], layout)
    params = BoostParams(subsample=0.9)
    work.begin(9.5, params, 0)
    tree = boosting.Tree()
    for _ in range(3):
        tree.add(0.0, 0.0)
    tree.column[0], tree.code[0], tree.left[0], tree.right[0] = 1, 0, 1, 2
    drawn = boosting._draw(work.blocks[0], params, 0)
    for fresh, wanted in (([], [0]), ([0], [1, 2])):  # one node is large, the other is not
        g, h = work.sums(tree, fresh, wanted)
        for k, node in enumerate(wanted):
            inside = drawn & (np.ones(n, bool) if node == 0 else (codes[1] <= 0) == (node == 1))
            for c, (lo, hi) in enumerate(zip(layout.offsets, layout.offsets[1:])):
                assert np.array_equal(h[k, lo:hi], np.bincount(codes[c][inside], minlength=hi - lo))
                assert np.allclose(g[k, lo:hi], np.bincount(codes[c][inside], (9.5 - label)[inside], hi - lo), atol=0.02)
    assert len(layout.bundles) < len(layout.sizes)


def test_rows_without_a_label_still_count():
    layout = Layout([np.array([0.0])], [])
    work = boosting._Local([boosting.Block([np.array([0, 0, 1], np.uint8)], np.array([1.0, np.nan, 2.0]), np.zeros(0), 0)], layout)
    work.begin(0.0, BoostParams(), 0)
    g, h = work.sums(boosting.Tree(value=[0.0], column=[-1]), [], [0])
    assert h.tolist() == [[2, 1]] and np.isnan(g[0, 0]) and g[0, 1] == -2
