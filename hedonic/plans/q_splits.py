"""Queries over time splits and leakage protection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators import split
from hedonic.operators.ranking import rank_first
from hedonic.plans.registry import query
from hedonic.plans.sales import TEST_MIN, TRAIN_MAX, VAL_YEAR, dated_sales, over, sales, split_sales

CUT, VAL_CUT = "2000-07-01", "2001-03-01"
_TWO = f"two AS (SELECT *, CASE WHEN sold_date < TIMESTAMP '{CUT}' THEN 'train' ELSE 'test' END AS split FROM sales)"
_THREE = (
    f"three AS (SELECT *, CASE WHEN sold_date < TIMESTAMP '{CUT}' THEN 'train' WHEN sold_date < TIMESTAMP '{VAL_CUT}' THEN 'val' "
    "ELSE 'test' END AS split FROM sales)"
)


def three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.by_cutoff(sales(spark, sf_dir, wide_last=True), CUT, VAL_CUT, require_all=False)


@query("spl_two_way", over("sales", "SELECT sale_key, split FROM two", _TWO))
def two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.by_cutoff(sales(spark, sf_dir), CUT).select("sale_key", "split")


@query("spl_three_way", over("sales", "SELECT sale_key, split FROM three", _THREE))
def three_way_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.by_cutoff(sales(spark, sf_dir), CUT, VAL_CUT).select("sale_key", "split")


@query(
    "spl_by_year",
    over(
        "dated",
        f"""SELECT sale_key, CASE WHEN year <= {TRAIN_MAX - 1} THEN 'train' WHEN year = {VAL_YEAR} THEN 'val' WHEN year >= {TEST_MIN} THEN 'test' END AS split
            FROM dated WHERE year <= {TRAIN_MAX - 1} OR year = {VAL_YEAR} OR year >= {TEST_MIN}""",
    ),
)
def by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a gap year before the validation year, whose rows belong nowhere."""
    return split.by_year(dated_sales(spark, sf_dir), TRAIN_MAX - 1, VAL_YEAR, TEST_MIN, require_all=True).select("sale_key", "split")


@query(
    "spl_from_config",
    over(
        "sales",
        """SELECT '3way' AS kind, sale_key, split FROM three t
           WHERE NOT (split = 'val' AND property_id IN (SELECT property_id FROM three WHERE split = 'train'))
             AND NOT (split = 'test' AND property_id IN (SELECT property_id FROM three WHERE split IN ('train', 'val')))
             AND NOT (split = 'test' AND NOT (starts_with(zip_code, '00') OR starts_with(zip_code, '05')))""",
        _THREE,
    ),
)
def from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = {
        "split": {
            "cutoff": CUT,
            "val_cutoff": VAL_CUT,
            "property_id_col": "property_id",
            "forbid_property_cross_split": True,
            "restrict_test_zip_prefixes": ["00", "05"],
            "min_train_rows": 100,
        }
    }
    # what is written on the way is only what the settings and the result name
    used = sales(spark, sf_dir, wide_last=True).select("sale_key", "property_id", "sold_date", "zip_code")
    kind, out = split.from_settings(used, settings)
    return out.select(F.lit(kind).alias("kind"), "sale_key", "split")


# DuckDB reads a hexadecimal number with this prefix
_HASH = "CAST(('0x' || substr(md5(sale_key || ':0'), 1, 15)) AS BIGINT)"


@query("spl_random", over("sales", f"SELECT sale_key, CASE WHEN ({_HASH} % 1000000) / 1000000.0 < 0.2 THEN 'test' ELSE 'train' END AS split FROM sales"))
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = split.by_hash(sales(spark, sf_dir), "sale_key", test_size=0.2, seed=0)
    return out.select("sale_key", "split")


@query(
    "spl_no_cross_entity",
    over(
        "sales",
        """SELECT sale_key, split FROM three
           WHERE NOT (split = 'val' AND property_id IN (SELECT property_id FROM three WHERE split = 'train'))
             AND NOT (split = 'test' AND property_id IN (SELECT property_id FROM three WHERE split IN ('train', 'val')))""",
        _THREE,
    ),
)
def no_cross_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.no_cross_entity(three_way(spark, sf_dir).select("sale_key", "property_id", "split"), "property_id").select("sale_key", "split")


@query(
    "spl_no_cross_entity_test_first",
    over(
        "sales",
        """SELECT sale_key, split FROM two
           WHERE split = 'test' OR property_id NOT IN (SELECT property_id FROM two WHERE split = 'test')""",
        _TWO,
    ),
)
def no_cross_entity_test_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split.by_cutoff(sales(spark, sf_dir, wide_last=True), CUT, require_all=False)
    return split.no_cross_entity(df.select("sale_key", "property_id", "split"), "property_id", prefer="test", three_way=False).select("sale_key", "split")


@query("spl_zip_prefix", over("sales", "SELECT sale_key, split FROM two WHERE split = 'train' OR starts_with(zip_code, '00') OR starts_with(zip_code, '07')", _TWO))
def zip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split.by_cutoff(sales(spark, sf_dir), CUT, require_all=False)
    return split.keep_test_zips(df, ["00", "07"]).select("sale_key", "split")


@query("spl_min_rows", over("splits", "SELECT split, count(*) AS n FROM splits GROUP BY split"))
def min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split.require_splits(split_sales(spark, sf_dir), {"train": 100, "val": 10, "test": 10})
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "spl_sorted",
    over("splits", "SELECT split, sale_key, row_number() OVER (PARTITION BY split ORDER BY sold_date, sale_key) AS position FROM splits"),
)
def sorted_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each split in date order; the position says where a row comes."""
    df = split_sales(spark, sf_dir).select("split", "sale_key", "sold_date")
    return split.sorted_parts(df).select("split", "sale_key", "position")


@query(
    "spl_disjoint_cover",
    over(
        "splits",
        """SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
                  count(*) FILTER (WHERE split = 'test') AS test_rows, count(*) AS labelled_rows,
                  (SELECT count(*) FROM sales) AS all_rows, count(split) = (SELECT count(*) FROM sales) AS covers_all
           FROM splits""",
    ),
)
def disjoint_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.coverage(sales(spark, sf_dir), split_sales(spark, sf_dir))


@query(
    "spl_downsample",
    over(
        "splits",
        "SELECT split, count(*) AS n, count(DISTINCT sale_key) AS keys, min(sale_key) AS first_key, max(sale_key) AS last_key FROM kept GROUP BY split",
        f"kept AS (SELECT split, sale_key FROM splits WHERE split <> 'train' OR sale_key IN (SELECT sale_key FROM splits WHERE split = 'train' ORDER BY {_HASH}, sale_key LIMIT 3000))",
    ),
)
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = split.downsample_train(split_sales(spark, sf_dir), 3000, "sale_key", seed=0)
    edges = [F.min("sale_key").alias("first_key"), F.max("sale_key").alias("last_key")]
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sale_key").alias("keys"), *edges)
