import random
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hedonic import session
from hedonic.operators import groupstats as gs
from hedonic.operators import metrics, profile, split
from hedonic.operators.target import log_target, smear_factor, to_dollars


def labelled(spark, rows, schema="k int, e string, split string"):
    return spark.createDataFrame(rows, schema)


def sales(spark, n=400, seed=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        zip_code = "00501" if rnd.random() < 0.4 else rnd.choice(["10001", "20002", "30003", None])
        rows.append((i, zip_code, datetime(rnd.randint(2000, 2004), rnd.randint(1, 12), 5), round(rnd.lognormvariate(12, 0.5), 2) if rnd.random() > 0.05 else None))
    return spark.createDataFrame(rows, "k int, zip_code string, sold_date timestamp_ntz, price double")


def test_year_split_bounds_and_gap(spark):
    out = split.by_year(sales(spark), 2001, 2003, 2004)
    got = {r["split"]: (r["lo"], r["hi"]) for r in out.groupBy("split").agg(F.min(F.year("sold_date")).alias("lo"), F.max(F.year("sold_date")).alias("hi")).collect()}
    assert got == {"train": (2000, 2001), "val": (2003, 2003), "test": (2004, 2004)}
    assert out.count() == out.select("k").distinct().count()


def test_cutoff_errors(spark):
    df = sales(spark)
    for bad in (("1990-01-01", None), ("2003-01-01", "2002-01-01")):
        with pytest.raises(ValueError):
            split.by_cutoff(df, *bad)
    with pytest.raises(KeyError):
        split.by_cutoff(df.drop("sold_date"), "2002-01-01")
    missing = df.withColumn("sold_date", F.when(F.col("k") > 0, F.col("sold_date")))
    with pytest.raises(ValueError, match="1 rows"):
        split.by_cutoff(missing, "2002-01-01")
    with pytest.raises(ValueError, match="too few"):
        split.from_settings(df, {"split": {"cutoff": "2002-01-01", "min_test_rows": 10_000}})
    with pytest.raises(KeyError):
        split.from_settings(df, {"split": {}})


def test_two_way_from_settings(spark):
    kind, out = split.from_settings(sales(spark), {"split": {"cutoff": "2002-01-01", "min_val_rows": 5}})
    assert kind == "2way" and set(split.split_counts(out)) == {"train", "test"}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_entities_stay_on_one_side(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", limit)
    rows = [(1, "a", "train"), (2, "a", "val"), (3, "a", "test"), (4, "b", "val"), (5, "b", "test"), (6, "c", "test"), (7, None, "train"), (8, None, "test")]
    keys = lambda df: sorted(r["k"] for r in df.collect())
    assert keys(split.no_cross_entity(labelled(spark, rows), "e")) == [1, 4, 6, 7, 8]
    assert keys(split.no_cross_entity(labelled(spark, rows), "e", prefer="val")) == [2, 4, 6, 7, 8]
    two = [r for r in rows if r[2] != "val"]
    assert keys(split.no_cross_entity(labelled(spark, two), "e", prefer="test", three_way=False)) == [3, 5, 6, 7, 8]
    assert sorted(r["e"] for r in split.shared_entities(labelled(spark, rows), "e").collect()) == ["a"]


def test_zip_prefixes_touch_test_rows_only(spark):
    df = spark.createDataFrame([(1, "00501", "train"), (2, "10001", "test"), (3, "501.0", "test"), (4, None, "test")], "k int, zip_code string, split string")
    assert sorted(r["k"] for r in split.keep_test_zips(df, ["10"]).collect()) == [1, 2]
    assert split.keep_test_zips(df, []).count() == 4


def test_hashed_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    one = {r["k"]: r["split"] for r in split.by_hash(df.repartition(1), "k", 0.2, 1).collect()}
    assert one == {r["k"]: r["split"] for r in split.by_hash(df.repartition(7), "k", 0.2, 1).collect()}
    assert 300 < sum(s == "test" for s in one.values()) < 500
    assert one != {r["k"]: r["split"] for r in split.by_hash(df, "k", 0.2, 2).collect()}


def test_downsampling_is_exact_and_repeatable(spark):
    df = split.by_year(sales(spark), 2002, 2003, 2004)
    counts = split.split_counts(df)
    picks = [sorted(r["k"] for r in split.part(split.downsample_train(df.repartition(n), 50, "k", 7), "train").collect()) for n in (1, 5)]
    assert picks[0] == picks[1] and len(picks[0]) == 50
    after = split.split_counts(split.downsample_train(df, 50, "k", 7))
    assert (after["val"], after["test"]) == (counts["val"], counts["test"])


def brute_baseline(train, test, least):
    def level(pick):
        groups = {}
        for r in train:
            groups.setdefault(pick(r), []).append(r["price"])
        out = {}
        for key, prices in groups.items():
            known = [p for p in prices if p is not None]
            if len(prices) >= least and known:
                out[key] = statistics.median(known)
        return out

    zy, z, y = level(lambda r: (r["zip_code"], r["sold_date"].year)), level(lambda r: r["zip_code"]), level(lambda r: r["sold_date"].year)
    overall = statistics.median(r["price"] for r in train if r["price"] is not None)
    out = {}
    for r in test:
        year = r["sold_date"].year
        out[r["k"]] = zy.get((r["zip_code"], year), z.get(r["zip_code"], y.get(year, overall)))
    return out


@pytest.mark.parametrize("least,limit", [(1, 10**6), (15, 10**6), (15, 0), (60, 10**6)])
def test_baseline_equals_brute_force(spark, monkeypatch, least, limit):
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", limit)
    df = split.by_cutoff(sales(spark), "2003-07-01")
    train, test = split.part(df, "train"), split.part(df, "test")
    out = gs.predict_baseline(test, gs.fit_baseline(train, min_group_size=least))
    assert out.columns == [*test.columns, "pred_baseline"]
    got = {r["k"]: r["pred_baseline"] for r in out.collect()}
    assert got == pytest.approx(brute_baseline(train.collect(), test.collect(), least))


def test_baseline_without_keys_is_the_overall_median(spark):
    df = sales(spark).select("k", "price")
    out = gs.predict_baseline(df, gs.fit_baseline(df, apply_columns=df.columns))
    want = statistics.median(r["price"] for r in df.collect() if r["price"] is not None)
    assert {r["pred_baseline"] for r in out.collect()} == {want}


def test_fitted_tables_do_not_see_later_targets(spark):
    df = split.by_cutoff(sales(spark).withColumn("year", F.year("sold_date")), "2003-01-01")
    bent = df.withColumn("price", F.when(F.col("split") == "test", F.col("price") * 100).otherwise(F.col("price")))
    results = []
    for frame in (df, bent):
        fit = gs.fit_neighbors(split.part(frame, "train"), min_group_size=3)
        out = gs.attach_asof(split.part(frame, "test"), fit).drop("price")
        results.append(sorted(map(tuple, gs.predict_baseline(out, gs.fit_baseline(split.part(frame, "train"))).collect()), key=str))
    assert results[0] == results[1]


def test_neighbor_columns_and_modes(spark):
    df = sales(spark).withColumn("year", F.year("sold_date"))
    train, late = df.filter("year <= 2002"), df.filter("year > 2002")
    settings = {"features": {"leakage_safe_neighbors": {"enabled": True, "min_group_size": 1}}}
    tr, la, added = gs.neighbors_from_settings(train, late, settings)
    assert added == ["zip_year_price_median", "zip_year_price_median_prev"]
    assert "zip_year_price_median_prev" in tr.columns and "zip_year_price_median" in la.columns
    # no later year was seen in training, so an exact match never happens
    assert la.select("zip_year_price_median").distinct().count() == 1
    tr, la, added = gs.neighbors_from_settings(train, late, settings, mode="asof", symmetric=True)
    assert added == ["zip_year_price_median"] and added[0] in tr.columns
    assert la.select("zip_year_price_median").distinct().count() > 1
    assert gs.neighbors_from_settings(train, late, {})[2] == []
    settings["features"]["leakage_safe_neighbors"]["stats"] = [{"kind": "mean", "of": "price"}]
    with pytest.raises(NotImplementedError):
        gs.neighbors_from_settings(train, late, settings)


def test_target_round_trip_and_smear(spark):
    df = log_target(spark.createDataFrame([(100.0,), (0.0,), (2500.5,)], "price double"))
    back = df.select("price", to_dollars(F.col("label")).alias("back")).collect()
    assert all(r["price"] == pytest.approx(r["back"]) for r in back)
    assert smear_factor(df.withColumn("prediction", F.col("label"))) == pytest.approx(1.0)
    assert smear_factor(df.withColumn("prediction", F.col("label")).limit(0)) == 1.0
    assert smear_factor(df, log=False) is None
    with pytest.raises(Exception, match="negative target"):
        log_target(spark.createDataFrame([(-1.0,)], "price double")).collect()
    # (e^y - 1) * s, not e^y * s - 1
    assert df.select(to_dollars(F.lit(1.0), 2.0)).first()[0] == pytest.approx(2 * (2.718281828459045 - 1))


def test_r2_without_spread_is_missing(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "price double, pred_model double")
    row = metrics.regression_metrics(df).first()
    assert (row["MAE"], row["RMSE"], row["R2"]) == (1.0, 1.0, None)


def test_slices_keep_missing_groups_and_break_ties_by_name(spark):
    rows = [("b", 1.0, 3.0), ("a", 1.0, 3.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "state string, price double, pred_model double")
    assert [r["state"] for r in metrics.slices_multi(df, ["state"], min_count=1).collect()] == ["a", "b", None]
    single = metrics.slices_single(df, ["state"], min_count=1, topk=1).collect()
    assert [(r["label"], r["rank"]) for r in single] == [("a (n=1)", 1)]


def test_fingerprint_ignores_order_but_not_copies(spark):
    df = sales(spark, 50)
    first = profile.fingerprint(df).first()
    assert first == profile.fingerprint(df.repartition(7).orderBy(F.desc("k"))).first()
    assert first["fingerprint"] != profile.fingerprint(df.union(df.limit(2))).first()["fingerprint"]
    assert profile.fingerprint(df.limit(0)).first()["num_rows"] == 0


def test_na_summary_counts_nan_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "v double, s string")
    got = {r["column"]: (r["rows"], r["na_count"]) for r in profile.na_summary(df).collect()}
    assert got == {"v": (3, 2), "s": (3, 1)}
    assert profile.na_summary(df.limit(0), ["v"]).first()["rows"] == 1


def test_slices_take_all_spellings_of_a_zip_for_one(spark):
    rows = [("501.0", 1.0, 3.0), (" 501", 1.0, 3.0), ("00501", 1.0, 6.0), ("10001", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "zip_code string, price double, pred_model double")
    assert [(r["value"], r["n"], r["MAE"]) for r in metrics.slices_single(df, ["zip_code"], min_count=1).collect()] == [("00501", 3, 3.0), ("10001", 1, 0.0)]
    assert metrics.slices_single(df.withColumn("zip_code", F.lit(501.0)), ["zip_code"], min_count=1).first()["value"] == "00501"


def test_fingerprint_sees_every_change_of_a_number(spark):
    def printed(x):
        return profile.fingerprint(spark.createDataFrame([(x,)], "v double")).first()["fingerprint"]

    values = [0.0, 1.0, 1e-7, 1.0000001, 1e30, 1e300, 0.1 + 0.2, 0.3, float("nan"), float("inf"), None]
    assert len({printed(x) for x in values}) == len(values)
