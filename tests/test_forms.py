"""Date forms, neighbour statistics fitted together, sorted parts and sampling by key."""

import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hedonic.functions.scalars import parse_timestamp
from hedonic.operators import clean, groupstats, split
from hedonic.operators.quantiles import exact_quantiles

FORMS = {
    "2023-02-01": datetime(2023, 2, 1), "2023-02-01 10:30": datetime(2023, 2, 1, 10, 30), "2023-02-01T10:30:05": datetime(2023, 2, 1, 10, 30, 5),
    "Feb 1, 2023 10:30": datetime(2023, 2, 1, 10, 30), "February 1, 2023 9:05:07": datetime(2023, 2, 1, 9, 5, 7), "1 Feb 2023": datetime(2023, 2, 1),
    "2023-02": datetime(2023, 2, 1), "2023/2": datetime(2023, 2, 1), "20230201": datetime(2023, 2, 1), "01/02/23": datetime(2023, 1, 2),
    "1/2/70 08:15": datetime(1970, 1, 2, 8, 15), "13/02/2023": datetime(2023, 2, 13), "13-02-23": datetime(2023, 2, 13), "02/13/2023": datetime(2023, 2, 13),
    "02/01/2023 23:59:59": datetime(2023, 2, 1, 23, 59, 59), "2023/02/01": datetime(2023, 2, 1), " 2023-02-01 ": datetime(2023, 2, 1),
    "13/13/2023": None, "2023-13": None, "no sale": None, "": None, "12": None, "5.5": None, "Feb 30, 2023": None, "Feb 1, 2023 25:00": None,
}


def test_date_forms(spark):
    df = spark.createDataFrame([(k,) for k in FORMS], "text string")
    got = {r["text"]: r["t"] for r in df.select("text", parse_timestamp(F.col("text")).alias("t")).collect()}
    assert got == FORMS


def test_dropped_dates_are_counted(spark):
    df = spark.createDataFrame([("2023-02-01",), ("soon",), (None,), (" ",), ("2023-02",)], "raw string").withColumn("sold_date", parse_timestamp(F.col("raw")))
    rows = clean.audit_rules(df, clean.date_rules(df, "raw")).orderBy("step_no").collect()
    assert [(r["step"], r["rows_before"], r["rows_after"]) for r in rows] == [("sold_date given", 5, 3), ("sold_date understood", 3, 2)]


def test_statistics_fitted_together_equal_single_fits(spark):
    rnd = random.Random(8)
    rows = [(f"z{rnd.randrange(4)}", 2000 + rnd.randrange(3), rnd.random() * 100, rnd.random() if rnd.random() > 0.2 else None) for _ in range(300)]
    df = spark.createDataFrame(rows, "zip_code string, year int, price double, size double")
    both = groupstats.fit_neighbor_stats(df, {"p": "price", "s": "size", "p2": "price"}, min_group_size=5)
    for fit, of in zip(both, ("price", "size", "price")):
        alone = groupstats.fit_neighbors(df, of, None, fit.name, 5)
        assert fit.overall == alone.overall and fit.medians.rows == alone.medians.rows
        assert sorted(map(tuple, fit.medians.table.collect())) == sorted(map(tuple, alone.medians.table.collect()))
        assert sorted(map(tuple, fit.by_zip.table.collect())) == sorted(map(tuple, alone.by_zip.table.collect()))


def test_settings_name_unknown_statistics(spark):
    df = spark.createDataFrame([("z", 2000, 1.0)], "zip_code string, year int, price double")
    section = {"enabled": True, "stats": [{"kind": "median"}, {"kind": "mode"}]}
    with pytest.raises(NotImplementedError, match="mode"):
        groupstats.neighbors_from_settings(df, df, {"features": {"leakage_safe_neighbors": section}})


def test_sorted_parts_and_setting(spark):
    rows = [(f"k{i}", datetime(2000 + i % 3, 1, 1 + i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "sale_key string, sold_date timestamp_ntz").repartition(3)
    kind, out = split.from_settings(df, {"split": {"cutoff": "2001-01-01", "val_cutoff": "2002-01-01", "sort_output": True, "sort_key": "sale_key"}})
    got = {(r["split"], r["position"]): r["sale_key"] for r in out.collect()}
    want = {}
    for name, year in (("train", 2000), ("val", 2001), ("test", 2002)):
        own = sorted((d, k) for k, d in rows if d.year == year)
        want |= {(name, i): k for i, (_, k) in enumerate(own, 1)}
    assert kind == "3way" and got == want


def test_random_split_follows_the_key(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    got = {r["k"]: r["split"] for r in split.by_hash(df, "k", 0.3, 5).collect()}
    share = {k: int(hashlib.md5(f"{k}:5".encode()).hexdigest()[:15], 16) % 1_000_000 / 1e6 for k in got}
    assert got == {k: "test" if s < 0.3 else "train" for k, s in share.items()}


def test_quantiles_of_a_group_with_half_of_all_rows(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("k"), (F.col("id") % 1013).cast("double").alias("v"))
    got = {r["k"]: (r["n_rows"], r["m"]) for r in exact_quantiles(df, "v", [0.5], ["k"], ["m"]).collect()}
    want = {r["k"]: (r["n"], r["m"]) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.percentile("v", 0.5).alias("m")).collect()}
    assert got == want


@pytest.mark.parametrize("limit", [10**6, 0])
def test_a_hot_zip_joins_whole(spark, monkeypatch, limit):
    from hedonic import session

    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", limit)
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "00001").otherwise(F.lpad((F.col("id") % 50).cast("string"), 5, "0")).alias("zip_code"), F.lit(2000).alias("year"), F.col("id").cast("double").alias("price"))
    fit = groupstats.fit_neighbors(rows, min_group_size=1)
    out = groupstats.attach_same_year(rows, fit, "m")
    assert out.count() == 3000 and out.filter("m IS NULL").count() == 0
