"""Queries over sources and schema resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.plans.flagship import rounded
from hedonic.plans.registry import query
from hedonic.plans.sales import over, predicted_sales, sales
from hedonic.session import scratch_path
from hedonic.sinks.runs import RunStore
from hedonic.sources import schema
from hedonic.sources.tables import scan_csv, scan_predictions


@query(
    "src_csv_scan",
    over("sales", "SELECT sale_key, property_id, sold_date, prev_sold_date, state, city, zip_raw, price, bed, house_size, year_built FROM sales"),
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["sale_key", "property_id", "sold_date", "prev_sold_date", "state", "city", "zip_raw", "price", "bed", "house_size", "year_built"]
    df = sales(spark, sf_dir).select(*columns)
    path = scratch_path(spark, "sales") + ".csv"
    # leading and trailing blanks belong to the data
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return scan_csv(spark, path, df.schema)


@query(
    "src_preds_scan",
    over(
        "preds",
        """SELECT state, count(*) AS n, round(sum(price), 2) AS sum_price, round(sum(pred_model), 2) AS sum_pred
           FROM preds GROUP BY state""",
    ),
)
def preds_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = RunStore(spark, scratch_path(spark, "preds"), "r1")
    path = store.predictions_csv(predicted_sales(spark, sf_dir), "test_preds")
    df = scan_predictions(spark, path, schema="sold_date TIMESTAMP_NTZ, city STRING, state STRING, zip_code STRING, price DOUBLE, pred_model DOUBLE")
    out = df.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("sum_price"), F.sum("pred_model").alias("sum_pred"))
    return rounded(out, 2, "sum_price", "sum_pred")


@query("src_normalize_names", over("sales", "SELECT sale_key, price, zip_code, state FROM sales"))
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", "price", "zip_code", "state").toDF(" Sale_Key", "PRICE ", " Zip_Code ", "State")
    return schema.normalize_names(df)


@query("src_alias_resolve", over("sales", "SELECT sale_key, sold_date, prev_sold_date, zip_code, house_size, acre_lot, price FROM sales"))
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", "sold_date", "prev_sold_date", "zip_code", "house_size", "acre_lot", "price")
    return schema.resolve_aliases(df.toDF("sale_key", "closing_date", "last_sold_date", "postal_code", "sqft", "lot_size", "amount"))


@query(
    "src_detect_date",
    over("sales", "SELECT CAST(year(sold_date) AS INT) AS year, count(*) AS n, max(sold_date) AS last_sold FROM sales GROUP BY 1"),
)
def detect_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir, wide_last=True).withColumn("settled", F.date_format("sold_date", "MM/dd/yyyy HH:mm:ss")).drop("sold_date")
    found = schema.detect_date(df)
    return found.groupBy(F.year("sold_date").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.max("sold_date").alias("last_sold"))


@query("src_date_from_parts", over("sales", "SELECT sale_key, CAST(sold_date AS DATE) AS sold_day FROM sales"))
def date_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = F.col("sold_date")
    parts = sales(spark, sf_dir).select(
        "sale_key", F.year(sold).alias("yr_sold_year"), F.date_format(sold, "MMMM").alias("sale_month"), F.dayofmonth(sold).alias("sale_day")
    )
    return schema.date_from_parts(parts).select("sale_key", F.col("sold_date").cast("date").alias("sold_day"))


@query("src_detect_price", over("sales", "SELECT sale_key, price FROM sales"))
def detect_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select(
        "sale_key",
        F.col("price_raw").alias("quoted_usd"),
        (F.col("price") / 100000).alias("tax_cost"),
        F.col("price").alias("assessed_value"),
        "bed",
    )
    return schema.detect_price(df).select("sale_key", "price")


@query("src_require_columns", over("sales", "SELECT state, count(*) AS n, true AS complete FROM sales GROUP BY state"))
def require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = schema.require_columns(sales(spark, sf_dir), ("price", "sold_date", "state"))
    return df.groupBy("state").agg(F.count(F.lit(1)).alias("n")).withColumn("complete", F.lit(True))


@query("src_relax_required", over("sales", "SELECT zip_code, count(*) AS n FROM sales WHERE price IS NOT NULL GROUP BY zip_code"))
def relax_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    undated = sales(spark, sf_dir).select("zip_code", "price")
    df = schema.require_columns(undated, require_date=False)
    return df.na.drop(subset=["price"]).groupBy("zip_code").agg(F.count(F.lit(1)).alias("n"))


@query("src_nonempty_guard", over("sales", "SELECT city, count(*) AS n FROM sales WHERE price >= 1000 GROUP BY city"))
def nonempty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = schema.require_rows(sales(spark, sf_dir).filter(F.col("price") >= 1000))
    return df.groupBy("city").agg(F.count(F.lit(1)).alias("n"))
