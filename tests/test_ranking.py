import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hedonic.operators.calibration import ece_weighted, equal_width_bins, quantile_bins
from hedonic.operators.ranking import qcut, rank_first


def test_ranks_are_dense_positions_of_the_global_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([1.0, 2.0, 2.0, rnd.random()]), f"k{i:05d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "v double, k string").repartition(6)
    got = {r["k"]: (r["rank"], r["n"]) for r in rank_first(df, ["v", "k"], total="n").collect()}
    assert got == {k: (i, 2000) for i, (_, k) in enumerate(sorted(rows), 1)}


@pytest.mark.parametrize("n,q", [(499, 20), (1000, 7), (20, 20), (21, 20), (5, 2), (2, 1), (1, 10)])
def test_bins_equal_pandas(spark, n, q):
    rnd = random.Random(n * q)
    rows = [(float(rnd.randrange(12)), i) for i in range(n)]
    got = {r["k"]: r["bin"] for r in qcut(spark.createDataFrame(rows, "v double, k int"), "v", "k", q).collect()}
    ranks = pd.Series([r[0] for r in rows]).rank(method="first")
    if n == 1:
        assert got == {0: 0}
    else:
        assert got == dict(enumerate(pd.qcut(ranks, q=q, labels=False, duplicates="drop").tolist()))


def test_bin_sizes_of_the_published_calibration_table(spark):
    """499 predictions in 20 bins: 25 rows each, but 24 in the bin that holds the odd one out."""
    df = spark.range(499).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("pred_model"), (F.col("id") * 2.0 + 1).alias("price"))
    bins = {r["bin"]: r["n"] for r in quantile_bins(df, "k").collect()}
    assert bins == {b: 24 if b == 10 else 25 for b in range(20)}
    row = ece_weighted(quantile_bins(df, "k")).first()
    assert (row["bins"], row["total_points"], row["ECE_abs"]) == (20, 499, pytest.approx(1.0))


def test_equal_width_bins_keep_or_drop_the_maximum(spark):
    values = [0.0, 0.15, 0.35, 0.75, 1.0, 1.0]
    df = spark.createDataFrame([(v, v) for v in values], "price double, pred_model double")
    assert {r["bin"]: r["n"] for r in equal_width_bins(df, bins=10).collect()} == {0: 1, 1: 1, 3: 1, 7: 1, 9: 2}
    kept = sum(r["n"] for r in equal_width_bins(df, bins=10).collect())
    dropped = sum(r["n"] for r in equal_width_bins(df, bins=10, drop_maximum=True).collect())
    assert (kept, dropped) == (6, 4)


def test_equal_predictions_share_one_bin(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "price double, pred_model double")
    assert [(r["bin"], r["n"]) for r in equal_width_bins(df, bins=4).collect()] == [(3, 2)]
