"""Plans and passes that decide how queries grow: tables are joined once, rows are binned once and spread out."""

import pytest
from pyspark.sql import functions as F

from hedonic.models import boosting, encode, sweep
from hedonic.operators import split
from hedonic.plans import q_closed, q_sinks
from hedonic.plans import sales as plan_sales
from hedonic.sinks.runs import RunStore


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def joined(spark):
    """Rows that take a join to make."""
    sales = spark.createDataFrame([(i, i % 5, f"199{i % 3}-01-0{1 + i % 9}") for i in range(60)], "sale_key long, place long, day string")
    places = spark.createDataFrame([(i, f"0050{i}") for i in range(5)], "place long, zip_code string")
    df = sales.join(places.hint("merge"), "place").withColumn("sold_date", F.col("day").cast("timestamp_ntz"))
    return df.withColumn("property_id", F.when(F.col("sale_key") > 3, F.col("sale_key") % 20))


def test_protection_makes_its_rows_once(joined):
    labelled = split.by_cutoff(joined, "1991-01-01", "1992-01-01")
    out = split.no_cross_entity(labelled, "property_id")
    assert "Inner" in plan_of(labelled) and "Inner" not in plan_of(out)
    kept = {r["sale_key"]: r["split"] for r in out.collect()}
    rows = labelled.collect()
    sides = {r["property_id"]: {s["split"] for s in rows if s["property_id"] == r["property_id"]} for r in rows}
    for r in rows:
        earlier = {"train": set(), "val": {"train"}, "test": {"train", "val"}}[r["split"]]
        assert (r["sale_key"] in kept) == (r["property_id"] is None or not sides[r["property_id"]] & earlier)


def test_split_from_settings_makes_its_rows_once(joined):
    section = {"cutoff": "1991-01-01", "property_id_col": "property_id", "forbid_property_cross_split": True, "restrict_test_zip_prefixes": ["005"], "min_train_rows": 1}
    kind, out = split.from_settings(joined, {"split": section})
    assert kind == "2way" and "Inner" not in plan_of(out)
    two = split.by_cutoff(joined, "1991-01-01")
    expected = split.no_cross_entity(two, "property_id", three_way=False).select(out.columns)
    assert out.exceptAll(expected).isEmpty() and expected.exceptAll(out).isEmpty()


def test_sales_join_line_items_to_parts_first(spark, tmp_path):
    date = F.lit("1996-03-04").cast("timestamp_ntz")
    rows = [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 1, 2), (3, 1, None), (None, 1, 1), (4, 1, 9), (5, 1, 1)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long").withColumns(
        {"l_suppkey": F.lit(7).cast("long"), "l_shipdate": date, "l_extendedprice": F.lit(1000.5), "l_quantity": F.lit(20.0), "l_discount": F.lit(0.04)}
    )
    orders = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (3, 1), (4, None), (5, 8)], "o_orderkey long, o_custkey long").withColumn("o_orderdate", date)
    customers = spark.createDataFrame([(1, 0, "A"), (2, 1, "B"), (3, None, "C"), (2, 0, None)], "c_custkey long, c_nationkey int, c_mktsegment string")
    nations = spark.createDataFrame([(0, "X"), (1, "Y")], "n_nationkey int, n_name string")
    parts = spark.createDataFrame([(1, 3), (2, 4), (2, 5)], "p_partkey long, p_size int")
    for name, df in {"lineitem": lines, "orders": orders, "customer": customers, "nation": nations, "part": parts}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = plan_sales.sales(spark, str(tmp_path), wide_last=True)
    plain = spark.sql(plan_sales.SALES_SQL, **{t: plan_sales.table(spark, str(tmp_path), t) for t in plan_sales.TABLES})
    assert out.schema == plain.schema and out.count() == plain.count() > 0
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    outermost = next(line for line in plan_of(out).splitlines() if "Join" in line)
    assert "l_orderkey" in outermost and "o_orderkey" in outermost


@pytest.mark.parametrize("module, run", [(q_closed, "run_rewrite"), (q_sinks, "run_layout"), (q_sinks, "latest_run")])
def test_counts_that_are_written_often_are_counted_once(spark, joined, monkeypatch, module, run):
    plans, write = [], RunStore.write
    monkeypatch.setattr(module, "split_sales", lambda *_: split.by_cutoff(joined, "1991-01-01"))
    monkeypatch.setattr(RunStore, "write", lambda self, kind, df, *rest: plans.append(plan_of(df)) or write(self, kind, df, *rest))
    out = getattr(module, run)(spark, "")
    assert plans and not any("Inner" in p for p in plans)
    assert {r["n"] for r in out.collect()} == {20, 40}


def test_rows_are_binned_once_for_all_boosted_fits(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 20), "ab"[i % 2], 100.0 + i % 20) for i in range(200)], "x double, c string, price double")
    encoder = encode.fit_encoder(df, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    binned, bin_rows = [], boosting.bin_rows
    monkeypatch.setattr(boosting, "bin_rows", lambda *given: binned.append(1) or bin_rows(*given))
    trials = sweep.sweep(df, df, encoder, {"boosted": [{"n_estimators": 2, "max_depth": d} for d in (1, 2, 3)]})
    assert len(trials) == 3 and len(binned) == 1


def test_spread_fit_keeps_margins_only_for_a_next_tree(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    vectors = spark.createDataFrame([(Vectors.dense([float(i % 7)]), float(i % 7)) for i in range(70)], ["features", "label"])
    layout, blocks = boosting.binned(vectors, 1, [])
    kept, keep = [], boosting._Spread._keep
    monkeypatch.setattr(boosting._Spread, "_keep", lambda self, margin: kept.append(1) or keep(self, margin))
    boosting.boost(blocks, layout, boosting.BoostParams(rounds=3, depth=1), task_rows=1)
    assert len(kept) == 3  # the start, and after the first two trees


def test_rows_of_a_forest_are_spread_out(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 20), "abcd"[i % 4], 100.0 + i % 20) for i in range(400)], "x double, c string, price double").coalesce(1)
    encoder = encode.fit_encoder(df, ["x"], ["c"], {"preprocess": {"one_hot": {"min_frequency": 1}}})
    parts = F.spark_partition_id().alias("part")
    assert encoder.spread(df).select(parts).distinct().count() == 1
    monkeypatch.setattr(encode, "TOTAL_NUMBERS", 1000)
    monkeypatch.setattr(encode, "TASK_NUMBERS", 250)
    spread = encoder.spread(df)
    assert spread.select(parts).distinct().count() == 8 and sorted(spread.collect()) == sorted(df.collect())
    spreads, plain = [], encode.FeatureEncoder.spread
    monkeypatch.setattr(encode.FeatureEncoder, "spread", lambda self, rows: spreads.append(1) or plain(self, rows))
    model = sweep.refit(df, "rf", {"n_estimators": 2, "max_depth": 2}, ["x"], ["c"], {})
    assert model.predict(df).count() == 400 and len(spreads) == 1


@pytest.mark.parametrize("run", [sweep.run_sweep, sweep.run_by_rmse])
def test_runs_count_their_splits_in_the_written_rows(joined, monkeypatch, run):
    class Counted(Exception):
        pass

    plans = []

    def counts(df):
        plans.append(plan_of(df))
        raise Counted

    monkeypatch.setattr(split, "split_counts", counts)
    settings = {"split": {"train_max_year": 1990, "val_year": 1991, "test_min_year": 1992}, "features": {"engineered": []}}
    with pytest.raises(Counted):
        run(joined, settings, None, "sale_key", candidates=[])
    assert len(plans) == 1 and "Inner" not in plans[0]
