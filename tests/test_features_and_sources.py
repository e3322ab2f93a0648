from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.functions import scalars
from hedonic.operators import clean, features
from hedonic.sources import schema
from hedonic.sources.load import load_sales
from hedonic.sources.tables import scan_csv, scan_predictions

DATES = "sold_date timestamp_ntz, prev_sold_date timestamp_ntz, price double"


def test_calendar_features_and_types(spark):
    rows = [(datetime(2023, 2, 1), datetime(2020, 2, 1), 250_000.0), (datetime(2024, 3, 15), None, 310_000.0)]
    out = features.time_features(spark.createDataFrame(rows, DATES))
    assert isinstance(out.schema["year"].dataType, T.IntegerType) and isinstance(out.schema["month"].dataType, T.IntegerType)
    assert isinstance(out.schema["years_since_prev_sale"].dataType, T.DoubleType)
    first, second = out.orderBy("sold_date").collect()
    assert (first["year"], first["month"], first["season"]) == (2023, 2, 0)
    assert first["years_since_prev_sale"] == pytest.approx(1096 / 365.25)
    assert second["years_since_prev_sale"] is None and second["season"] == 1


def test_calendar_needs_a_date(spark):
    with pytest.raises(TypeError):
        features.calendar_features(spark.createDataFrame([("2023-02-01", 1.0)], "sold_date string, price double"))
    with pytest.raises(KeyError):
        features.calendar_features(spark.createDataFrame([(1.0,)], "price double"))


def test_no_previous_sale_gives_an_empty_column(spark):
    out = features.years_since_previous(spark.createDataFrame([(datetime(2022, 1, 1),), (datetime(2022, 6, 1),)], "sold_date timestamp_ntz"))
    assert [r["years_since_prev_sale"] for r in out.collect()] == [None, None]


def test_elapsed_days_round_down(spark):
    rows = [(datetime(2020, 1, 2, 0, 0), datetime(2020, 1, 1, 12, 0), 0), (datetime(2020, 1, 1, 12), datetime(2020, 1, 2, 0), -1), (datetime(2020, 3, 1), datetime(2020, 2, 1), 29)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", scalars.elapsed_days(F.col("a"), F.col("b"))).collect())


def test_expressions(spark):
    rows = [(3.0, 2.0, 0.25, 1500.0), (4.0, 0.0, 0.5, 2000.0), (2.0, None, None, None)]
    out = features.add_expressions(spark.createDataFrame(rows, "bed double, bath double, acre_lot double, house_size double"), features.STANDARD_EXPRESSIONS)
    a, b, c = out.collect()
    assert (a["bed_per_bath"], b["bed_per_bath"], c["bed_per_bath"]) == (1.5, 4.0, None)
    assert b["log_house_size"] > a["log_house_size"] and c["log_house_size"] is None


def test_expression_errors(spark):
    df = spark.createDataFrame([(1.0,)], "bed double")
    with pytest.raises(NameError, match="oops"):
        features.add_expressions(df, [{"name": "oops", "expr": "does_not_exist + 1"}])
    with pytest.raises(RuntimeError, match="broken"):
        features.add_expressions(df, [{"name": "broken", "expr": "bed +"}])
    for bad in ({"expr": "bed"}, {"name": "x"}):
        with pytest.raises(ValueError):
            features.add_expressions(df, [bad])


def test_negative_property_age_is_missing(spark):
    df = spark.createDataFrame([(datetime(2000, 5, 1), 1990), (datetime(2000, 5, 1), 2003)], "sold_date timestamp_ntz, year_built int")
    assert [r["property_age"] for r in features.calendar_features(df).collect()] == [10, None]


def test_usable_columns(spark):
    train = spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double")
    assert features.usable_columns(train, ["a", "b", "c", "d"], train.drop("c")) == ["a"]
    with pytest.raises(ValueError):
        features.usable_columns(train, ["b"], train)


@pytest.mark.parametrize(
    "text,want",
    [
        ("2023-03-01", datetime(2023, 3, 1)),
        ("2023-3-1", datetime(2023, 3, 1)),
        ("2023-03-01 10:11:12", datetime(2023, 3, 1, 10, 11, 12)),
        ("2023-03-01T10:11:12", datetime(2023, 3, 1, 10, 11, 12)),
        (" 3/1/2023 ", datetime(2023, 3, 1)),
        ("03/01/2023 10:11:12", datetime(2023, 3, 1, 10, 11, 12)),
        ("2023/03/01", datetime(2023, 3, 1)),
        ("20230301", datetime(2023, 3, 1)),
        ("Mar 1, 2023", datetime(2023, 3, 1)),
        ("March 1, 2023", datetime(2023, 3, 1)),
        ("1 Mar 2023", datetime(2023, 3, 1)),
        ("2023-02-30", None),
        ("08210", None),
        ("NATION_2023", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(scalars.parse_timestamp(F.col("d")).alias("d")).first()["d"] == want


@pytest.mark.parametrize("text,want", [("501", "00501"), (" 1234.0 ", "01234"), ("98765-4321", "987654321"), ("abc", ""), ("", ""), (None, None)])
def test_zip_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "z string")
    assert df.select(scalars.zip_normalize(F.col("z")).alias("z")).first()["z"] == want


def test_zip_numbers(spark):
    df = spark.createDataFrame([(8210.0,), (None,)], "z double")
    assert [r["z"] for r in df.select(scalars.zip_normalize(F.col("z"), T.DoubleType()).alias("z")).collect()] == ["08210", None]


@pytest.mark.parametrize("text,want", [("$1,234.50", 1234.5), ("USD 5", 5.0), ("n/a", None), ("--", None), ("1-2", None), ("-7", -7.0), (None, None)])
def test_price_text(spark, text, want):
    assert spark.createDataFrame([(text,)], "p string").select(scalars.parse_price(F.col("p")).alias("p")).first()["p"] == want


def test_whole_numbers(spark):
    df = spark.createDataFrame([(0.5, "12"), (1.5, " 7 "), (2.5, "x")], "f double, s string")
    out = df.select(scalars.parse_int(F.col("f"), T.DoubleType()).alias("f"), scalars.parse_int(F.col("s")).alias("s")).collect()
    assert [tuple(r) for r in out] == [(0, 12), (2, 7), (2, None)]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("1.5",)], "s string").select(scalars.parse_int(F.col("s"))).collect()


def test_usd_label(spark):
    df = spark.createDataFrame([(1234567.0,), (0.5,), (1.5,), (-12.0,), (None,)], "x double")
    got = [r[0] for r in df.select(scalars.usd_label(F.col("x"))).collect()]
    assert got == [*[f"${x:,.0f}" for x in (1234567.0, 0.5, 1.5, -12.0)], "—"]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(0.5,), (5.0,), (None,)], "x double")
    assert [r[0] for r in df.select(scalars.clip(F.col("x"), 1.0, 2.0)).collect()] == [1.0, 2.0, None]


def test_aliases_prefer_the_first_spelling_and_keep_a_canonical_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], "list_price int, sale_price int, sqft int")
    assert schema.resolve_aliases(df).columns == ["list_price", "price", "house_size"]
    both = spark.createDataFrame([(1, 2)], "price int, sale_price int")
    assert schema.resolve_aliases(both).columns == ["price", "sale_price"]


def test_previous_dates_are_no_sale_dates_unless_wanted(spark):
    df = spark.createDataFrame([("2020-01-01", "x")] * 20, "prev_sold_date string, note string")
    assert "sold_date" not in schema.detect_date(df).columns
    assert "sold_date" in schema.detect_date(df, include_previous=True).columns


def test_text_needs_enough_parsed_rows_to_be_a_date(spark):
    few = spark.createDataFrame([("2020-01-01",)] * 9 + [("x",)] * 5, "when_closed string")
    enough = spark.createDataFrame([("2020-01-01",)] * 10 + [("x",)] * 5, "when_closed string")
    assert schema.choose_date(few) is None
    assert schema.choose_date(enough) == "when_closed"


def test_price_choice(spark):
    df = spark.createDataFrame([(5.0, 200_000.0, 1.0), (None, 300_000.0, 2.0)], "amount_a double, value_b double, bed double")
    assert schema.choose_price(df) == "value_b"
    assert schema.choose_price(df.select(F.col("value_b").alias("figure"), "bed")) == "figure"


def test_requirements(spark):
    df = spark.createDataFrame([(1.0, "x")], "amount double, record_time string")
    with pytest.raises(ValueError, match="record_time.*amount"):
        schema.require_columns(df)
    priced = df.withColumn("price", F.lit(1.0))
    assert schema.require_columns(priced, require_date=False) is priced
    with pytest.raises(ValueError):
        schema.require_rows(df.filter("amount > 5"))


def test_strict_dates(spark):
    good = spark.createDataFrame([("2020-01-01",)], "sold_date string")
    assert clean.strict_dates(good).first()["sold_date"] == datetime(2020, 1, 1)
    with pytest.raises(ValueError, match="1 values"):
        clean.strict_dates(spark.createDataFrame([("2020-01-01",), ("soon",)], "sold_date string"))
    with pytest.raises(ValueError, match="1 rows"):
        clean.strict_dates(spark.createDataFrame([("2020-01-01",), (None,)], "sold_date string"))


def test_caps_follow_the_filters_before_them(spark):
    rows = [(float(i), float(100 - i)) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = clean.apply_filters(df, {"a": {"min": 51}, "b": {"max_percentile": 50}})
    # b is capped at the median of the rows that a left: 0..49
    assert out.count() == 50 and out.agg(F.max("b")).first()[0] == 24.5


def test_load_from_csv(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("Sold Price,Closing_Date,ZIP,Bed,Bath,SqFt,City\n" + "\n".join(["$250000,2023-02-01,501.0,3,2,1500, Ames "] * 3 + ["n/a,2023-02-01,501,3,2,1500,", "$9,2023-02-01,501,3,2,1500,X", "$300000,,501,3,2,1500,X", "$300000,2023-01-01,501,1,9,1500,X"]))
    raw = scan_csv(spark, str(path)).withColumnRenamed("Sold Price", "Sold_Price")
    out = load_sales(raw, {"data": {"filters": {"price": {"min": 1000}}}}).collect()
    assert [(r["price"], r["zip_code"], r["city"], r["sold_date"]) for r in out] == [(250000.0, "00501", "Ames", datetime(2023, 2, 1))] * 3


def test_predictions_need_both_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1.0,)], "price double").write.parquet(path)
    with pytest.raises(ValueError, match="pred_model"):
        scan_predictions(spark, path)


def test_all_caps_come_from_one_fit(spark, monkeypatch):
    rows = [(float(i), float(100 - i), float(i % 7) if i % 5 else None) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    filters = {"a": {"min": 20, "max_percentile": 90, "min_percentile": 5}, "b": {"max": 60, "max_percentile": 75}, "c": {"max_percentile": 50}}
    one_by_one = df
    for column, spec in filters.items():
        one_by_one = clean.apply_filters(one_by_one, {column: spec})
    fits, fit = [], clean.column_quantiles
    monkeypatch.setattr(clean, "column_quantiles", lambda *given: fits.append(given) or fit(*given))
    together = clean.apply_filters(df, filters)
    assert len(fits) == 1 and sorted(map(str, together.collect())) == sorted(map(str, one_by_one.collect()))
    assert clean.apply_filters(df, {"a": {"min": 101}, "b": {"max_percentile": 50}}).count() == 0
