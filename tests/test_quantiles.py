import math
import random

import numpy as np
import pytest

from hedonic.operators import quantiles


def brute(rows, probs):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(value)
    out = {}
    for key, values in groups.items():
        kept = [v for v in values if v is not None and math.isfinite(v)]
        out[key] = (len(values), len(kept), [float(np.percentile(kept, p * 100)) if kept else None for p in probs])
    return out


def sample(seed):
    rnd = random.Random(seed)
    rows = [("hot", rnd.choice([rnd.gauss(0, 1e4), float(round(rnd.random() * 50)), 1e-310 * rnd.random(), -1e12 * rnd.random()])) for _ in range(600)]
    rows += [(rnd.choice(["a", "b", None]), rnd.lognormvariate(11, 1)) for _ in range(300)]
    rows += [("same", 7.25)] * 200 + [("one", -0.0), ("empty", None), ("empty", None)]
    rows += [("dirty", float("nan")), ("dirty", float("inf")), ("dirty", 3.0), ("dirty", 5.0), ("dirty", None)]
    return rows


@pytest.mark.parametrize("cell_rows", [10**6, 20, 2])
def test_grouped_quantiles_equal_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(quantiles, "CELL_MAX_ROWS", cell_rows)
    probs = [0.0, 0.01, 0.5, 0.95, 1.0]
    rows = sample(cell_rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, "v", probs, ["k"], list("abcde")).collect()}
    want = brute(rows, probs)
    assert set(got) == set(want)
    for key, (n, m, qs) in want.items():
        assert (got[key]["n_rows"], got[key]["n_values"]) == (n, m)
        for name, q in zip("abcde", qs):
            assert got[key][name] == (None if q is None else pytest.approx(q, rel=1e-12, abs=1e-300))


def test_levels_equal_separate_groupings(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice([1, 2]), rnd.random() * 100) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, year int, v double")
    got = quantiles.exact_quantiles(df, "v", [0.5], ["k", "year"], ["m"], [["k", "year"], ["year"], []]).collect()
    for level, pick in ((0, lambda r: (r[0], r[1])), (1, lambda r: (None, r[1])), (2, lambda r: (None, None))):
        want = {key: qs[0] for key, (_, _, qs) in brute([(pick(r), r[2]) for r in rows], [0.5]).items()}
        assert {(r["k"], r["year"]): r["m"] for r in got if r["level"] == level} == pytest.approx(want)


def test_no_rows_and_no_keys(spark):
    empty = spark.createDataFrame([], "v double")
    row = quantiles.exact_quantiles(empty, "v", [0.5], [], ["m"]).first()
    assert (row["n_rows"], row["n_values"], row["m"]) == (0, 0, None)
    assert quantiles.exact_quantiles(spark.range(1, 102), "id", [0.5], [], ["m"]).first()["m"] == 51.0


def test_coarse_cells_never_decrease(spark):
    rnd = random.Random(5)
    values = sorted([0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 2.0] + [rnd.choice([-1, 1]) * 2 ** rnd.uniform(-1073, 1023) for _ in range(3000)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    cells = [r["c"] for r in df.select("i", quantiles._coarse_cell(df["v"]).alias("c")).orderBy("i").collect()]
    assert cells == sorted(cells)


def test_large_lookups_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_MAX_ROWS", 0)
    rows = sample(9)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in quantiles.exact_quantiles(df, "v", [0.5], ["k"], ["m"]).collect()}
    assert got == pytest.approx({k: qs[0] for k, (_, _, qs) in brute(rows, [0.5]).items()}, nan_ok=True)
