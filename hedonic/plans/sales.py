"""The SALES view: the sales schema of this library laid over the given tables.

The text is valid in Spark SQL and in the oracle's SQL alike. It adds some dirt (missing
values, padded ZIPs, currency text) that the cleaning operators have to handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators.features import calendar_features
from hedonic.operators.split import by_year

TABLES = ["lineitem", "orders", "customer", "nation", "part"]

# The split years that the queries use: the tables hold sales from 1995 to 2001.
TRAIN_MAX, VAL_YEAR, TEST_MIN = 1999, 2000, 2001
# The number of rows a group needs; some (ZIP, year) groups have fewer.
MIN_GROUP = 40

SALES_SQL = """
SELECT
  concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
            CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
            CAST(CAST(l_shipdate AS DATE) AS STRING))                        AS sale_key,
  l_partkey                                                                  AS property_id,
  l_shipdate                                                                 AS sold_date,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END                AS prev_sold_date,
  n_name                                                                     AS state,
  CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END               AS city,
  lpad(CAST((o_custkey % 200) * 37 + 501 AS STRING), 5, '0')                 AS zip_code,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL
       WHEN l_linenumber % 3 = 0 THEN concat(CAST((o_custkey % 200) * 37 + 501 AS STRING), '.0')
       WHEN l_linenumber % 3 = 1 THEN concat(' ', CAST((o_custkey % 200) * 37 + 501 AS STRING), ' ')
       ELSE lpad(CAST((o_custkey % 200) * 37 + 501 AS STRING), 5, '0') END   AS zip_raw,
  l_extendedprice                                                            AS price,
  CASE WHEN l_suppkey % 41 = 0 THEN 'n/a'
       ELSE concat('$ ', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING), ' USD') END AS price_raw,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(floor(l_quantity / 10) AS DOUBLE) END     AS bed,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber % 8 AS DOUBLE) END           AS bath,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(p_size * 60 AS DOUBLE) END               AS house_size,
  l_discount * 20 + 0.0                                                      AS acre_lot,
  CAST(1900 + p_partkey % 105 AS INT)                                        AS year_built
FROM {lineitem}
JOIN {orders}   ON l_orderkey  = o_orderkey
JOIN {customer} ON o_custkey   = c_custkey
JOIN {nation}   ON c_nationkey = n_nationkey
JOIN {part}     ON l_partkey   = p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The same joins for Spark, in an order that shuffles narrow rows: parts meet the bare line
# items, customers and nations the orders, and the widest rows are made by the last join.
_JOINS = """
FROM ({lineitem} JOIN {part} ON l_partkey = p_partkey)
JOIN ({orders} JOIN ({customer} JOIN {nation} ON c_nationkey = n_nationkey) ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
"""


def sales(spark: SparkSession, sf_dir: str, wide_last: bool = False) -> DataFrame:
    """The view; with ``wide_last`` in the other order of joins, for queries to whom the order of rows is nothing.

    Fits that draw rows by their place keep the order of the text.
    """
    text = SALES_SQL[: SALES_SQL.index("FROM {lineitem}")] + _JOINS if wide_last else SALES_SQL
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES})


def dated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SALES with year, month, season and property_age."""
    return calendar_features(sales(spark, sf_dir))


def split_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated SALES with the year split."""
    return by_year(dated_sales(spark, sf_dir), TRAIN_MAX, VAL_YEAR, TEST_MIN)


def with_prediction(df: DataFrame) -> DataFrame:
    """A plain formula as ``pred_model``, so that evaluation has an exact SQL counterpart.

    It takes few distinct values: ties are the hard case for ranks and bins.
    """
    size = F.coalesce(F.col("house_size"), F.lit(1500.0))
    bed = F.coalesce(F.col("bed"), F.lit(2.0))
    return df.withColumn("pred_model", size * 15.0 + bed * 900.0 + 5000.0)


def predicted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_prediction(sales(spark, sf_dir))


# --- the same in SQL, as common table expressions -------------------------------

_SALES = "sales AS (" + SALES_SQL.format(**{t: t for t in TABLES}) + ")"
_DATED = (
    "dated AS (SELECT *, CAST(year(sold_date) AS INT) AS year, CAST(month(sold_date) AS INT) AS month FROM sales)"
)
_SPLITS = (
    f"splits AS (SELECT *, CASE WHEN year <= {TRAIN_MAX} THEN 'train' WHEN year = {VAL_YEAR} THEN 'val' "
    f"WHEN year >= {TEST_MIN} THEN 'test' END AS split FROM dated)"
)
_PREDS = (
    "preds AS (SELECT *, coalesce(house_size, 1500.0) * 15.0 + coalesce(bed, 2.0) * 900.0 + 5000.0 AS pred_model FROM sales)"
)
_ORDER = {"sales": [_SALES], "dated": [_SALES, _DATED], "splits": [_SALES, _DATED, _SPLITS], "preds": [_SALES, _PREDS]}


def baseline_ctes(name: str, train: str, apply: str, min_group: int = 1) -> list[str]:
    """The median baseline fitted on rows ``train`` of splits and applied to rows ``apply``."""
    having = f"HAVING count(*) >= {min_group}"
    return [
        f"{name}_tr AS (SELECT * FROM splits WHERE {train})",
        f"{name}_zy AS (SELECT zip_code, year, median(price) AS m FROM {name}_tr GROUP BY zip_code, year {having})",
        f"{name}_z AS (SELECT zip_code, median(price) AS m FROM {name}_tr GROUP BY zip_code {having})",
        f"{name}_y AS (SELECT year, median(price) AS m FROM {name}_tr GROUP BY year {having})",
        f"{name}_g AS (SELECT median(price) AS m FROM {name}_tr)",
        f"""{name} AS (SELECT s.*, coalesce(zy.m, z.m, y.m, (SELECT m FROM {name}_g)) AS pred_baseline
            FROM splits s
            LEFT JOIN {name}_zy zy ON s.zip_code IS NOT DISTINCT FROM zy.zip_code AND s.year IS NOT DISTINCT FROM zy.year
            LEFT JOIN {name}_z z ON s.zip_code IS NOT DISTINCT FROM z.zip_code
            LEFT JOIN {name}_y y ON s.year IS NOT DISTINCT FROM y.year
            WHERE {apply})""",
    ]


def over(base: str, select: str, *ctes: str) -> str:
    """SQL text: the expressions that ``base`` needs, further ones, and the final select."""
    return "WITH " + ",\n".join([*_ORDER[base], *ctes]) + "\n" + select
