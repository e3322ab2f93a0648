"""Run outputs and the settings of whole runs."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hedonic.models import sweep
from hedonic.sinks.runs import RunStore


@pytest.mark.parametrize("run_id", ["007", "20251201", "1e3", "2025-12-01"])
def test_run_ids_stay_text(spark, tmp_path, run_id):
    RunStore(spark, str(tmp_path), run_id).write("t", spark.range(3))
    again = RunStore(spark, str(tmp_path), "other")
    rows = again.read("t", run_id).collect()
    assert len(rows) == 3 and {r["run_id"] for r in rows} == {run_id}
    assert again.latest("t").count() == 3 and again.runs("t") == [run_id]


def test_run_ids_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="run id"):
        RunStore(spark, str(tmp_path), "a/b")
    with pytest.raises(FileNotFoundError):
        RunStore(spark, str(tmp_path), "a").read("never written")


def test_empty_outputs_and_empty_rewrites(spark, tmp_path):
    empty = spark.createDataFrame([], "grp string, MAE double")
    store = RunStore(spark, str(tmp_path), "one")
    assert store.slices(empty).columns == ["grp", "MAE", "run_id"] and store.slices(empty).count() == 0
    full = spark.createDataFrame([("a", 1.0)], "grp string, MAE double")
    assert RunStore(spark, str(tmp_path), "one").slices(full).count() == 1
    assert RunStore(spark, str(tmp_path), "one").slices(empty).count() == 0
    assert RunStore(spark, str(tmp_path), "two").write("parts", empty, ["grp"]).count() == 0


def test_a_rerun_drops_what_it_no_longer_writes(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1.0)], "state string, pred_model double")
    first = RunStore(spark, str(tmp_path), "007")
    for family in ("ridge", "001"):
        assert first.predictions(rows, "test", family).count() == 1
    assert {r["family"] for r in first.read("predictions", "007").collect()} == {"ridge", "001"}
    again = RunStore(spark, str(tmp_path), "007")
    again.predictions(rows, "test", "ridge")
    assert {r["family"] for r in again.read("predictions").collect()} == {"ridge"}


def test_runs_with_different_columns(spark, tmp_path):
    RunStore(spark, str(tmp_path), "a").write("t", spark.range(1))
    RunStore(spark, str(tmp_path), "b").write("t", spark.range(1).withColumn("more", F.lit("x")))
    assert {(r["run_id"], r["more"]) for r in RunStore(spark, str(tmp_path), "c").read("t").collect()} == {("a", None), ("b", "x")}


def test_grids_come_from_the_settings():
    asked = {"sweep": {"ridge": {"alpha": [3.0]}, "xgb": {"max_depth": [2, 3], "n_estimators": 5}}, "run": {"fast_sweep": True}}
    found = sweep.sweep_candidates(asked)
    assert found["ridge"] == [{"alpha": 3.0}] and "rf" not in found
    assert [c["max_depth"] for c in found["boosted"]] == [2, 3] and found["boosted"][0]["n_estimators"] == 5
    assert "boosted" not in sweep.sweep_candidates({"sweep": {"xgb": {"enabled": False}}})
    # of the depths None and 40 only one is fitted: neither can be followed beyond the deepest tree
    assert len(sweep.sweep_candidates({})["rf"]) == 2 * 3 * 2


@pytest.fixture(scope="module")
def homes(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.uniform(0, 10), f"z{i % 7}", datetime(2000 + i % 4, 3, 1)) for i in range(800)]
    df = spark.createDataFrame(rows, "k int, x double, zip_code string, sold_date timestamp_ntz")
    return df.withColumn("price", F.exp(F.col("x") * 0.2 + F.rand(3)) * 1000).persist()


SETTINGS = {
    "split": {"train_max_year": 2001, "val_year": 2002, "test_min_year": 2003},
    "features": {"numeric": ["x"], "categorical": [], "engineered": []},
    "model": {"kind": "ridge"},
    "tune": {"grid": {"alpha": [1.0, 2.0, 1.0]}},
}


def test_tuning_reads_kind_grid_and_smearing(spark, homes, tmp_path):
    out = sweep.run_by_rmse(homes, SETTINGS, RunStore(spark, str(tmp_path / "a"), "one"), "k")
    trials = out["trials"].orderBy("trial_no").collect()
    assert [(t["family"], t["params"]) for t in trials] == [("ridge", '{"alpha": 1.0}'), ("ridge", '{"alpha": 2.0}')]
    assert all(t["smear"] > 1.001 for t in trials)
    plain = {**SETTINGS, "target": {"duan_smearing": False}}
    out = sweep.run_by_rmse(homes, plain, RunStore(spark, str(tmp_path / "b"), "one"), "k")
    assert all(t["smear"] in (None, 1.0) for t in out["trials"].collect())


def test_neighbour_mode_changes_later_years(spark, homes, tmp_path):
    block = {"enabled": True, "group_keys": ["zip_code", "year"], "min_group_size": 1, "stats": [{"kind": "median", "of": "price", "name": "m"}]}
    settings = {**SETTINGS, "features": {**SETTINGS["features"], "leakage_safe_neighbors": block}}
    scores = {}
    for mode in ("exact", "asof"):
        changed = {**settings, "features": {**settings["features"], "leakage_safe_neighbors": {**block, "mode": mode}}}
        out = sweep.run_by_rmse(homes, changed, RunStore(spark, str(tmp_path / mode), "one"), "k", candidates=[{"alpha": 1.0}])
        scores[mode] = out["trials"].first()["MAE"]
    assert scores["exact"] != scores["asof"]


def test_a_fast_sweep_uses_all_training_rows(spark, tmp_path):
    many = spark.range(104_000).select(
        F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("x"), F.lit("z").alias("zip_code"),
        F.make_timestamp_ntz(2000 + (F.col("id") % 4 == 3).cast("int") + (F.col("id") % 8 == 7).cast("int"), F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("sold_date"),
        (1000.0 + F.col("id") % 97).alias("price"),
    )
    settings = {**SETTINGS, "split": {"train_max_year": 2000, "val_year": 2001, "test_min_year": 2002}, "run": {"fast_sweep": True}, "sweep": {"xgb": {"enabled": False}}}
    settings["eval"] = {"slices": {"group_cols": ["zip_code"], "min_count": 1}}
    out = sweep.run_sweep(many, settings, RunStore(spark, str(tmp_path), "one"), "k")
    row = out["training_rows"].first()
    assert row["used"] == row["available"] == 78_000
    settings["run"] = {"fast_sweep": True, "max_train_rows": 1000}
    row = sweep.run_sweep(many, settings, RunStore(spark, str(tmp_path), "two"), "k")["training_rows"].first()
    assert (row["available"], row["used"]) == (78_000, 1000)


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    from hedonic.session import scratch, written

    with scratch(spark):
        inner = written(spark.range(3), "inner")
        path = inner.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
        assert inner.count() == 3
    import os

    assert not os.path.exists(path)
    assert written(spark.range(2), "outer").count() == 2


def test_broadcasts_are_bounded_by_bytes(spark, monkeypatch):
    from hedonic import session

    lookup = session.Lookup(spark.createDataFrame([("x" * 1000, 1)] * 50, "k string, v int"))
    assert lookup.rows == 50 and 50_000 < lookup.size < 60_000
    assert "broadcast" in lookup.side._jdf.queryExecution().analyzed().toString().lower()
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 10_000)
    assert lookup.side is lookup.table


@pytest.mark.parametrize("parts", [None, ["k"]])
def test_failed_rewrite_leaves_the_old_rows(spark, tmp_path, parts):
    rows = spark.range(6).withColumn("k", (F.col("id") % 2).cast("string"))
    RunStore(spark, str(tmp_path), "one").write("t", rows, parts)
    broken = rows.withColumn("id", F.when(F.col("id") == 5, F.raise_error("stop").cast("long")).otherwise(F.col("id") + 100))
    again = RunStore(spark, str(tmp_path), "one")
    with pytest.raises(Exception, match="stop"):
        again.write("t", broken, parts)
    assert sorted(r["id"] for r in again.read("t").collect()) == list(range(6)) and again.runs("t") == ["one"]
    again.write("t", rows.filter("id < 2"), parts)
    assert again.read("t").count() == 2
