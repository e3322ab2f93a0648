"""Queries over profiles, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators import profile
from hedonic.operators.ranking import qcut, rank_first
from hedonic.operators.split import by_cutoff, part, shared_entities
from hedonic.plans.flagship import rounded
from hedonic.plans.registry import query
from hedonic.plans.sales import over, predicted_sales, sales, split_sales

_NUMERIC = ["price", "bed", "bath", "house_size", "acre_lot", "year_built", "property_id"]
_KIND = {"year_built": "int", "property_id": "bigint"}


def _numeric_sql(c: str) -> str:
    v = f"CAST({c} AS DOUBLE)"
    quantiles = ", ".join(
        f"round(quantile_cont({v}, {p}), 4) AS {n}" for p, n in ((0.01, "p1"), (0.05, "p5"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99"))
    )
    return f"""SELECT '{c}' AS "column", '{_KIND.get(c, "double")}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
        round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct, round(min({v}), 4) AS min, {quantiles},
        round(max({v}), 4) AS max, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std FROM sales"""


@query("agg_profile_numeric", over("sales", " UNION ALL ".join(_numeric_sql(c) for c in _NUMERIC)))
def numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.profile_numeric(sales(spark, sf_dir).select(*_NUMERIC))
    return rounded(rounded(out, 4, "min", "p1", "p5", "p50", "p95", "p99", "max", "mean", "std"), 6, "null_pct")


@query(
    "agg_profile_temporal",
    over(
        "sales",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS nulls, min({c}) AS first, max({c}) AS last FROM sales"""
            for c in ("sold_date", "prev_sold_date")
        ),
    ),
)
def temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_temporal(sales(spark, sf_dir))


@query(
    "agg_profile_topk",
    over(
        "sales",
        """SELECT "column", value, n AS count, CAST(rank AS INT) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM ("""
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM sales WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in ("state", "city", "zip_code", "zip_raw")
        )
        + ")) WHERE rank <= 10",
    ),
)
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_topk(sales(spark, sf_dir), ["state", "city", "zip_code", "zip_raw"])


@query(
    "agg_profile_table",
    over("sales", "SELECT count(*) AS num_rows, CAST(15 AS INT) AS num_columns, 'price' AS target_column, 'sales' AS source FROM sales"),
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_table(sales(spark, sf_dir), "price", "sales").drop("fingerprint")


def _printed(column: str) -> str:
    if column in ("sold_date", "prev_sold_date"):
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
    if column in ("price", "bed", "bath", "house_size", "acre_lot"):
        six = f"CAST({column} AS DECIMAL(38, 6))"
        return f"CASE WHEN CAST({six} AS DOUBLE) = {column} THEN CAST({six} AS VARCHAR) ELSE CAST({column} AS VARCHAR) END"
    return f"CAST({column} AS VARCHAR)"


_COLUMNS = [
    "sale_key", "property_id", "sold_date", "prev_sold_date", "state", "city", "zip_code", "zip_raw",
    "price", "price_raw", "bed", "bath", "house_size", "acre_lot", "year_built",
]
_PRINT = " || ".join(f"coalesce('=' || {_printed(c)}, '-') || chr(31)" for c in _COLUMNS)


@query(
    "agg_fingerprint",
    over("sales", f"SELECT count(*) AS num_rows, CAST(sum(CAST(('0x' || substr(md5({_PRINT}), 1, 15)) AS BIGINT)) AS DECIMAL(38, 0)) AS fingerprint FROM sales"),
)
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all columns."""
    return profile.fingerprint(sales(spark, sf_dir))


_NA_COLUMNS = ["prev_sold_date", "city", "zip_raw", "bed", "bath", "house_size", "price"]


def na_sql(table: str, columns: list[str], by: str | None = None) -> str:
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {lead}count(*) AS rows, CAST({len(columns)} AS INT) AS cols, '{c}' AS "column", count(*) - count({c}) AS na_count,
            round((count(*) - count({c})) * 100.0 / count(*), 6) AS na_pct FROM {table}{group}"""
        for c in columns
    )


@query("agg_na_summary", over("sales", na_sql("sales", _NA_COLUMNS)))
def na_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.na_summary(sales(spark, sf_dir), _NA_COLUMNS), 6, "na_pct")


@query(
    "agg_date_window",
    over("splits", "SELECT strftime(min(sold_date), '%Y-%m-%d') AS min_date, strftime(max(sold_date), '%Y-%m-%d') AS max_date FROM splits"),
)
def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_window(split_sales(spark, sf_dir))


@query("win_rank_first", over("preds", "SELECT sale_key, row_number() OVER (ORDER BY pred_model, sale_key) AS rank FROM preds"))
def rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = predicted_sales(spark, sf_dir).select("sale_key", "pred_model")
    return rank_first(df, ["pred_model", "sale_key"]).select("sale_key", "rank")


@query(
    "win_qcut",
    over(
        "preds",
        """SELECT sale_key, CAST(greatest(0, ((r - 1) * 20 + n - 2) // (n - 1) - 1) AS INT) AS bin
           FROM (SELECT sale_key, row_number() OVER (ORDER BY pred_model, sale_key) AS r, count(*) OVER () AS n FROM preds)""",
    ),
)
def quantile_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = predicted_sales(spark, sf_dir).select("sale_key", "pred_model")
    return qcut(df, "pred_model", "sale_key", 20).select("sale_key", "bin")


@query(
    "srt_by",
    over("sales", "SELECT zip_code, year, n, row_number() OVER (ORDER BY zip_code, year) AS position FROM g",
         "g AS (SELECT zip_code, CAST(year(sold_date) AS INT) AS year, count(*) AS n FROM sales GROUP BY 1, 2)"),
)
def sort_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted table, with the place of each row written down."""
    groups = sales(spark, sf_dir).groupBy("zip_code", F.year("sold_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return rank_first(groups, ["zip_code", "year"], "position")


@query("srt_topk", over("sales", "SELECT sale_key, price FROM sales ORDER BY price DESC, sale_key LIMIT 25"))
def sort_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select("sale_key", "price").orderBy(F.desc("price"), F.asc("sale_key")).limit(25)


@query(
    "set_union_all",
    over("splits", "SELECT sale_key, sold_date, CASE WHEN split = 'val' THEN bath END AS bath FROM splits WHERE split IN ('train', 'val')"),
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and val together; a column that one of them lacks is filled with NULL."""
    df = split_sales(spark, sf_dir).select("sale_key", "sold_date", "bath", "split")
    return part(df, "train").drop("bath", "split").unionByName(part(df, "val").drop("split"), allowMissingColumns=True)


@query(
    "set_id_overlap",
    over(
        "sales",
        """SELECT CAST(property_id AS STRING) AS property_id FROM sales WHERE sold_date < TIMESTAMP '2000-07-01'
           INTERSECT SELECT CAST(property_id AS STRING) FROM sales WHERE sold_date >= TIMESTAMP '2000-07-01'""",
    ),
)
def id_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_entities(by_cutoff(sales(spark, sf_dir), "2000-07-01", require_all=False), "property_id")
