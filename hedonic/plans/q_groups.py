"""Queries over train-only group statistics and the median baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators import groupstats as gs
from hedonic.operators.features import ensure_year
from hedonic.operators.split import by_cutoff, part
from hedonic.plans.flagship import rounded
from hedonic.plans.registry import query
from hedonic.plans.sales import MIN_GROUP, baseline_ctes, over, sales, split_sales

_TRAIN = "tr AS (SELECT * FROM splits WHERE split = 'train')"
_GY = f"gy AS (SELECT zip_code, year, median(price) AS m FROM tr WHERE zip_code IS NOT NULL GROUP BY zip_code, year HAVING count(*) >= {MIN_GROUP})"
_ZIPS = "zips AS (SELECT zip_code, median(price) AS zm FROM tr GROUP BY zip_code)"
_GLOBAL = "(SELECT median(price) FROM tr)"


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(split_sales(spark, sf_dir), "train")


def _fit(spark: SparkSession, sf_dir: str, fill: str = "global_median") -> gs.NeighborFit:
    return gs.fit_neighbors(_train(spark, sf_dir), min_group_size=MIN_GROUP, fill=fill)


@query(
    "agg_group_median",
    over("splits", f"SELECT zip_code, year, round(median(price), 4) AS median, count(*) AS n FROM tr GROUP BY zip_code, year HAVING count(*) >= {MIN_GROUP}", _TRAIN),
)
def group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.group_medians(_train(spark, sf_dir), ["zip_code", "year"], "price", MIN_GROUP, keep_null_keys=False), 4, "median")


@query(
    "agg_group_median_null_keys",
    over("splits", "SELECT city, round(median(price), 4) AS median, count(*) AS n FROM tr GROUP BY city", _TRAIN),
)
def group_median_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.group_medians(_train(spark, sf_dir), ["city"], "price"), 4, "median")


@query("agg_global_median", over("splits", "SELECT round(median(price), 4) AS median, count(*) AS n FROM tr", _TRAIN))
def global_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.group_medians(_train(spark, sf_dir), [], "price"), 4, "median")


@query("agg_entity_median", over("splits", "SELECT zip_code, round(median(price), 4) AS median, count(*) AS n FROM tr GROUP BY zip_code", _TRAIN))
def entity_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.group_medians(_train(spark, sf_dir), ["zip_code"], "price"), 4, "median")


@query(
    "nbr_train_prev_year",
    over(
        "splits",
        f"""SELECT s.sale_key, round(coalesce(g.m, {_GLOBAL}), 4) AS zip_year_price_median_prev
            FROM tr s LEFT JOIN gy g ON s.zip_code = g.zip_code AND s.year = g.year + 1""",
        _TRAIN,
        _GY,
    ),
)
def train_prev_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gs.attach_previous_year(_train(spark, sf_dir), _fit(spark, sf_dir))
    return rounded(out.select("sale_key", "zip_year_price_median_prev"), 4, "zip_year_price_median_prev")


# a mid-year cutoff: later rows of the same year find the year's own median
_MID = "mid AS (SELECT *, CASE WHEN sold_date < TIMESTAMP '2000-07-01' THEN 'train' ELSE 'test' END AS part FROM dated)"
_MID_TRAIN = "tr AS (SELECT * FROM mid WHERE part = 'train')"


def _mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_cutoff(ensure_year(sales(spark, sf_dir)), "2000-07-01", require_all=False)


@query(
    "nbr_apply_exact",
    over(
        "dated",
        f"""SELECT s.sale_key, round(coalesce(g.m, {_GLOBAL}), 4) AS zip_year_price_median
            FROM mid s LEFT JOIN gy g ON s.zip_code = g.zip_code AND s.year = g.year WHERE s.part = 'test'""",
        _MID,
        _MID_TRAIN,
        _GY,
    ),
)
def apply_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _mid(spark, sf_dir)
    fit = gs.fit_neighbors(part(df, "train"), min_group_size=MIN_GROUP)
    out = gs.attach_same_year(part(df, "test"), fit)
    return rounded(out.select("sale_key", "zip_year_price_median"), 4, "zip_year_price_median")


@query(
    "nbr_apply_asof",
    over(
        "splits",
        f"""SELECT s.sale_key, round(coalesce(
                (SELECT max_by(g.m, g.year) FROM gy g WHERE g.zip_code = s.zip_code AND g.year <= s.year), {_GLOBAL}), 4) AS zip_year_price_median
            FROM splits s WHERE s.split <> 'train'""",
        _TRAIN,
        _GY,
    ),
)
def apply_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gs.attach_asof(part(split_sales(spark, sf_dir), "val", "test"), _fit(spark, sf_dir))
    return rounded(out.select("sale_key", "zip_year_price_median"), 4, "zip_year_price_median")


@query(
    "nbr_fill",
    over(
        "splits",
        """SELECT s.sale_key, round(coalesce(g.m, z.zm), 4) AS zip_year_price_median
           FROM splits s LEFT JOIN gy g ON s.zip_code = g.zip_code AND s.year = g.year
           LEFT JOIN zips z ON s.zip_code = z.zip_code WHERE s.split = 'val'""",
        _TRAIN,
        _GY,
        _ZIPS,
    ),
)
def fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gs.attach_same_year(part(split_sales(spark, sf_dir), "val"), _fit(spark, sf_dir, "zip_median"))
    return rounded(out.select("sale_key", "zip_year_price_median"), 4, "zip_year_price_median")


SETTINGS = {
    "features": {
        "leakage_safe_neighbors": {
            "enabled": True,
            "group_keys": ["zip_code", "year"],
            "stats": [
                {"kind": "median", "of": "price", "name": "price_median"},
                {"kind": "median", "of": "acre_lot", "name": "lot_median"},
            ],
            "min_group_size": MIN_GROUP,
            "fill_strategy": "global_median",
        }
    }
}


@query(
    "nbr_from_config",
    over(
        "splits",
        """SELECT s.sale_key, round(coalesce(g.p, (SELECT median(price) FROM tr)), 4) AS price_median_prev,
                  round(coalesce(g.l, (SELECT median(acre_lot) FROM tr)), 6) AS lot_median_prev
           FROM tr s LEFT JOIN g ON s.zip_code = g.zip_code AND s.year = g.year + 1""",
        _TRAIN,
        f"""g AS (SELECT zip_code, year, median(price) AS p, median(acre_lot) AS l FROM tr
                  GROUP BY zip_code, year HAVING count(*) >= {MIN_GROUP})""",
    ),
)
def from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir)
    train, _, _ = gs.neighbors_from_settings(part(df, "train"), part(df, "val"), SETTINGS)
    return rounded(rounded(train.select("sale_key", "price_median_prev", "lot_median_prev"), 4, "price_median_prev"), 6, "lot_median_prev")


@query(
    "nbr_val_then_test",
    over(
        "splits",
        """SELECT v.sale_key, 'val' AS split, round(coalesce(a.m, (SELECT median(price) FROM tr)), 4) AS zip_price
           FROM splits v LEFT JOIN a ON v.zip_code = a.zip_code WHERE v.split = 'val'
           UNION ALL
           SELECT t.sale_key, 'test', round(coalesce(b.m, (SELECT median(price) FROM trv)), 4)
           FROM splits t LEFT JOIN b ON t.zip_code = b.zip_code WHERE t.split = 'test'""",
        _TRAIN,
        "trv AS (SELECT * FROM splits WHERE split IN ('train', 'val'))",
        f"ga AS (SELECT zip_code, year, median(price) AS m FROM tr GROUP BY 1, 2 HAVING count(*) >= {MIN_GROUP})",
        f"gb AS (SELECT zip_code, year, median(price) AS m FROM trv GROUP BY 1, 2 HAVING count(*) >= {MIN_GROUP})",
        "a AS (SELECT zip_code, max_by(m, year) AS m FROM ga GROUP BY 1)",
        "b AS (SELECT zip_code, max_by(m, year) AS m FROM gb GROUP BY 1)",
    ),
)
def val_then_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on train for val, and again on train and val for test; the last known year counts."""
    df = split_sales(spark, sf_dir)
    parts = []
    for names, to in ((["train"], "val"), (["train", "val"], "test")):
        fit = gs.fit_neighbors(part(df, *names), name="zip_price", min_group_size=MIN_GROUP)
        parts.append(gs.attach_asof(part(df, to), fit).select("sale_key", "split", "zip_price"))
    return rounded(parts[0].unionByName(parts[1]), 4, "zip_price")


_MID_SPLITS = (
    "splits AS (SELECT *, CASE WHEN sold_date < TIMESTAMP '2000-07-01' THEN 'train' ELSE 'test' END AS split FROM dated)"
)


@query(
    "bas_median_backoff",
    over(
        "dated",
        "SELECT sale_key, round(pred_baseline, 4) AS pred_baseline FROM b",
        _MID_SPLITS,
        *baseline_ctes("b", "split = 'train'", "split = 'test'", MIN_GROUP),
    ),
)
def median_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mid-year cutoff, so that every level of the fallback is used."""
    df = _mid(spark, sf_dir)
    fit = gs.fit_baseline(part(df, "train"), min_group_size=MIN_GROUP)
    return rounded(gs.predict_baseline(part(df, "test"), fit).select("sale_key", "pred_baseline"), 4, "pred_baseline")


@query("bas_global_only", over("splits", f"SELECT sale_key, round({_GLOBAL}, 4) AS pred_baseline FROM splits WHERE split = 'val'", _TRAIN))
def global_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir).select("sale_key", "price", "split")
    fit = gs.fit_baseline(part(df, "train"), apply_columns=df.columns)
    return rounded(gs.predict_baseline(part(df, "val"), fit).select("sale_key", "pred_baseline"), 4, "pred_baseline")


def baselines(spark: SparkSession, sf_dir: str, test_from: tuple[str, ...] = ("train", "val")) -> DataFrame:
    """Val rows predicted from train, test rows from the named splits."""
    df = split_sales(spark, sf_dir)
    val = gs.predict_baseline(part(df, "val"), gs.fit_baseline(part(df, "train")))
    return val.unionByName(gs.predict_baseline(part(df, "test"), gs.fit_baseline(part(df, *test_from))))


BASELINE_CTES = [
    *baseline_ctes("bv", "split = 'train'", "split = 'val'"),
    *baseline_ctes("bt", "split IN ('train', 'val')", "split = 'test'"),
    "both_parts AS (SELECT * FROM bv UNION ALL SELECT * FROM bt)",
]


@query("bas_val_test", over("splits", "SELECT sale_key, split, round(pred_baseline, 4) AS pred_baseline FROM both_parts", *BASELINE_CTES))
def val_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(baselines(spark, sf_dir).select("sale_key", "split", "pred_baseline"), 4, "pred_baseline")


@query(
    "bas_val_test_train_only",
    over(
        "splits",
        "SELECT sale_key, split, round(pred_baseline, 4) AS pred_baseline FROM b",
        *baseline_ctes("b", "split = 'train'", "split <> 'train'"),
    ),
)
def val_test_train_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir)
    out = gs.predict_baseline(part(df, "val", "test"), gs.fit_baseline(part(df, "train")))
    return rounded(out.select("sale_key", "split", "pred_baseline"), 4, "pred_baseline")


@query(
    "win_forward_fill",
    over(
        "splits",
        """SELECT zip_code, year, round(last_value(m IGNORE NULLS) OVER (PARTITION BY zip_code ORDER BY year ROWS UNBOUNDED PRECEDING), 4) AS median
           FROM (SELECT d.zip_code, d.year, g.m FROM (SELECT DISTINCT zip_code, year FROM splits) d
                 LEFT JOIN gy g ON d.zip_code = g.zip_code AND d.year = g.year)""",
        _TRAIN,
        _GY,
    ),
)
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (ZIP, year) that occurs gets the last known training median; years before the first stay empty."""
    years = split_sales(spark, sf_dir).select("zip_code", "year").distinct()
    return rounded(gs.carried_forward(_fit(spark, sf_dir), years), 4, "median")
