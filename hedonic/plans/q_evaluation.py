"""Queries over the target transform and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.functions.scalars import usd_label
from hedonic.operators import calibration, metrics, target
from hedonic.operators.profile import date_window
from hedonic.plans.flagship import rounded
from hedonic.plans.q_groups import BASELINE_CTES, baselines
from hedonic.plans.registry import query
from hedonic.plans.sales import over, predicted_sales, sales, with_prediction
from hedonic.session import written


# --- target ---------------------------------------------------------------------


@query("tgt_extract", over("sales", "SELECT price FROM sales"))
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target.extract_target(sales(spark, sf_dir))


@query("tgt_log1p", over("sales", "SELECT sale_key, round(ln(1 + price), 9) AS label FROM sales"))
def log1p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(target.log_target(sales(spark, sf_dir)).select("sale_key", "label"), 9, "label")


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log target and log prediction of the formula."""
    return target.log_target(predicted_sales(spark, sf_dir)).withColumn("prediction", F.log1p("pred_model"))


@query("tgt_smear_fit", over("preds", "SELECT round(avg(exp(ln(1 + price) - ln(1 + pred_model))), 8) AS smear FROM preds"))
def smear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = logged(spark, sf_dir)
    factor = target.smear_factor(df)
    return df.sparkSession.range(1).select(F.round(F.lit(factor), 8).alias("smear"))


@query(
    "tgt_inverse",
    over(
        "preds",
        """SELECT sale_key, round((exp(ln(1 + pred_model)) - 1) * (SELECT avg(exp(ln(1 + price) - ln(1 + pred_model))) FROM preds), 4) AS dollars
           FROM preds""",
    ),
)
def inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = logged(spark, sf_dir)
    out = df.withColumn("dollars", target.to_dollars(F.col("prediction"), target.smear_factor(df)))
    return rounded(out.select("sale_key", "dollars"), 4, "dollars")


# --- metrics --------------------------------------------------------------------


def _metric_sql(prediction: str) -> str:
    e = f"({prediction} - price)"
    return (
        f'round(avg(abs({e})), 4) AS "MAE", round(sqrt(avg({e} * {e})), 4) AS "RMSE", '
        f'round(1 - sum({e} * {e}) / (var_pop(price) * count(*)), 8) AS "R2"'
    )


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, "MAE", "RMSE"), 8, "R2")


@query("evl_metrics", over("preds", f"SELECT count(*) AS n, {_metric_sql('pred_model')} FROM preds"))
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_metrics(metrics.regression_metrics(predicted_sales(spark, sf_dir)))


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Val and test rows with the median baseline and the formula."""
    return with_prediction(baselines(spark, sf_dir))


BOTH = [*BASELINE_CTES, "evl AS (SELECT *, coalesce(house_size, 1500.0) * 15.0 + coalesce(bed, 2.0) * 900.0 + 5000.0 AS pred_model FROM both_parts)"]


@query(
    "evl_compare",
    over(
        "splits",
        f"""SELECT split, 'baseline' AS model, count(*) AS n, {_metric_sql('pred_baseline')} FROM evl GROUP BY split
            UNION ALL SELECT split, 'model', count(*), {_metric_sql('pred_model')} FROM evl GROUP BY split""",
        *BOTH,
    ),
)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.compare_predictions(both(spark, sf_dir), {"baseline": "pred_baseline", "model": "pred_model"}, by=["split"])
    return _rounded_metrics(out)


@query(
    "evl_gate",
    over(
        "splits",
        """SELECT round(avg(abs(pred_model - price)), 4) AS model_mae, round(avg(abs(pred_baseline - price)), 4) AS baseline_mae,
                  round(sqrt(avg((pred_model - price) ** 2)), 4) AS model_rmse, round(sqrt(avg((pred_baseline - price) ** 2)), 4) AS baseline_rmse,
                  avg(abs(pred_model - price)) < avg(abs(pred_baseline - price))
                    AND avg((pred_model - price) ** 2) < avg((pred_baseline - price) ** 2) AS model_beats_baseline
           FROM evl WHERE split = 'test'""",
        *BOTH,
    ),
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = both(spark, sf_dir).filter(F.col("split") == "test")
    out = metrics.beats_baseline(metrics.compare_predictions(test, {"baseline": "pred_baseline", "model": "pred_model"}))
    return rounded(out, 4, "model_mae", "baseline_mae", "model_rmse", "baseline_rmse")


_DIMENSIONS = ["state", "zip_code", "city"]
_ERRORS = "errs AS (SELECT *, abs(price - pred_model) AS e FROM preds)"


@query(
    "evl_slices_single",
    over(
        "preds",
        """SELECT dimension, value, n, round(mae, 4) AS "MAE", CAST(rank AS INT) AS rank, value || ' (n=' || CAST(n AS STRING) || ')' AS label
           FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY mae DESC, value) AS rank FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{d}' AS dimension, trim({d}) AS value, count(*) AS n, avg(e) AS mae FROM errs WHERE {d} IS NOT NULL GROUP BY trim({d}) HAVING count(*) >= 30"
            for d in _DIMENSIONS
        )
        + """ UNION ALL SELECT 'zip' AS dimension, lpad(regexp_replace(regexp_replace(trim(zip_raw), '\\.0$', ''), '[^0-9]', '', 'g'), 5, '0') AS value,
                  count(*) AS n, avg(e) AS mae FROM errs WHERE zip_raw IS NOT NULL GROUP BY ALL HAVING count(*) >= 30"""
        + ")) WHERE rank <= 20",
        _ERRORS,
    ),
)
def slices_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = predicted_sales(spark, sf_dir).withColumn("zip", F.col("zip_raw"))
    return rounded(metrics.slices_single(df, [*_DIMENSIONS, "zip", "no_such_column"], min_count=30, topk=20), 4, "MAE")


SLICES_MULTI = """SELECT state, city, count(*) AS count, round(avg(e), 4) AS "MAE", round(sqrt(avg(e * e)), 4) AS "RMSE"
           FROM errs GROUP BY state, city HAVING count(*) >= 30 ORDER BY avg(e) DESC, state, city LIMIT 20"""


def multi_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.slices_multi(predicted_sales(spark, sf_dir), ["state", "city"], min_count=30, topk=20), 4, "MAE", "RMSE")


@query("evl_slices_multi", over("preds", SLICES_MULTI, _ERRORS))
def slices_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_slices(spark, sf_dir)


@query("evl_residual", over("preds", "SELECT sale_key, round(pred_model - price, 4) AS residual FROM preds"))
def residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.residuals(predicted_sales(spark, sf_dir)).select("sale_key", "residual"), 4, "residual")


# --- calibration ----------------------------------------------------------------

QUANTILE_BINS = [
    """ranked AS (SELECT price, pred_model, row_number() OVER (ORDER BY pred_model, sale_key) AS r, count(*) OVER () AS n FROM preds)""",
    """bins AS (SELECT CAST(greatest(0, ((r - 1) * 20 + n - 2) // (n - 1) - 1) AS INT) AS bin, count(*) AS n, avg(pred_model) AS mean_pred,
                avg(price) AS mean_actual, min(pred_model) AS min_pred, max(pred_model) AS max_pred FROM ranked GROUP BY 1)""",
]
BIN_COLUMNS = (
    "bin, n, round(mean_pred, 4) AS mean_pred, round(mean_actual, 4) AS mean_actual, round(min_pred, 4) AS min_pred, round(max_pred, 4) AS max_pred"
)


def _rounded_bins(df: DataFrame) -> DataFrame:
    return rounded(df, 4, "mean_pred", "mean_actual", "min_pred", "max_pred")


def quantile_bins_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.quantile_bins(predicted_sales(spark, sf_dir), "sale_key", bins=20)


@query("evl_calib_quantile", over("preds", f"SELECT {BIN_COLUMNS} FROM bins", *QUANTILE_BINS))
def calib_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_bins(quantile_bins_of(spark, sf_dir))


def _width_bins(last: str) -> list[str]:
    return [
        "ext AS (SELECT min(pred_model) AS lo, max(pred_model) AS hi, (max(pred_model) - min(pred_model)) / 20 AS step FROM preds)",
        f"""edges AS (SELECT i, lo + i * step AS a, CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * step END AS b, hi
                      FROM ext, (SELECT CAST(range AS INT) AS i FROM range(20)))""",
        f"""bins AS (SELECT i AS bin, count(*) AS n, avg(pred_model) AS mean_pred, avg(price) AS mean_actual, min(pred_model) AS min_pred,
                     max(pred_model) AS max_pred FROM preds JOIN edges ON pred_model >= a AND (pred_model < b{last}) GROUP BY i)""",
    ]


@query("evl_calib_equal_width", over("preds", f"SELECT {BIN_COLUMNS} FROM bins", *_width_bins(" OR (i = 19 AND pred_model = hi)")))
def calib_equal_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_bins(calibration.equal_width_bins(predicted_sales(spark, sf_dir), bins=20))


@query("evl_calib_equal_width_half_open", over("preds", f"SELECT {BIN_COLUMNS} FROM bins", *_width_bins("")))
def calib_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open bins: the rows with the largest prediction fall out."""
    return _rounded_bins(calibration.equal_width_bins(predicted_sales(spark, sf_dir), bins=20, drop_maximum=True))


ECE_WEIGHTED = """SELECT count(*) AS bins, round(sum(n * abs(mean_pred - mean_actual)) / sum(n), 4) AS "ECE_abs",
                  round(sum(n * abs(mean_pred - mean_actual) / greatest(mean_actual, 1e-9)) / sum(n), 8) AS "ECE_rel",
                  CAST(sum(n) AS BIGINT) AS total_points FROM bins"""


@query("evl_ece_weighted", over("preds", ECE_WEIGHTED, *QUANTILE_BINS))
def ece_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(calibration.ece_weighted(quantile_bins_of(spark, sf_dir)), 4, "ECE_abs"), 8, "ECE_rel")


@query(
    "evl_ece_percent",
    over(
        "preds",
        """SELECT round(sum(n * abs(mean_pred - mean_actual)) / sum(n), 4) AS "ECE_abs",
                  round(100.0 * sum(n * abs(mean_pred - mean_actual)) / sum(n) / (SELECT avg(price) FROM preds), 8) AS "ECE_percent" FROM bins""",
        *_width_bins(" OR (i = 19 AND pred_model = hi)"),
    ),
)
def ece_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = predicted_sales(spark, sf_dir)
    return rounded(rounded(calibration.ece_percent(calibration.equal_width_bins(df, bins=20), df), 4, "ECE_abs"), 8, "ECE_percent")


@query(
    "evl_plot_ranges",
    over(
        "preds",
        """SELECT round(greatest(0.0, quantile_cont(v, 0.01)), 4) AS axis_low, round(quantile_cont(v, 0.99) * 1.05, 4) AS axis_high,
                  round((SELECT quantile_cont(abs(pred_model - price), 0.99) FROM preds) * 1.1, 4) AS residual_limit
           FROM (SELECT price AS v FROM preds UNION ALL SELECT pred_model FROM preds)""",
    ),
)
def plot_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.plot_ranges(predicted_sales(spark, sf_dir)), 4, "axis_low", "axis_high", "residual_limit")


@query(
    "evl_run_report",
    over(
        "splits",
        f"""SELECT split, model, n, "MAE", "RMSE", "R2", (SELECT strftime(min(sold_date), '%Y-%m-%d') FROM evl) AS min_date,
                   (SELECT strftime(max(sold_date), '%Y-%m-%d') FROM evl) AS max_date FROM (
              SELECT split, 'baseline' AS model, count(*) AS n, {_metric_sql('pred_baseline')} FROM evl GROUP BY split
              UNION ALL SELECT split, 'model', count(*), {_metric_sql('pred_model')} FROM evl GROUP BY split)""",
        *BOTH,
    ),
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, errors and the time span of an evaluation on one page."""
    df = written(both(spark, sf_dir).select("split", "sold_date", "price", "pred_baseline", "pred_model"), "predictions")
    table = metrics.compare_predictions(df, {"baseline": "pred_baseline", "model": "pred_model"}, by=["split"])
    window = date_window(df)
    return _rounded_metrics(table).select("*", window.select("min_date").scalar().alias("min_date"), window.select("max_date").scalar().alias("max_date"))


# Half dollars are left out of the comparison by rounding to whole dollars first.
@query(
    "fn_usd_label",
    over(
        "sales",
        """SELECT sale_key, CASE WHEN house_size IS NULL THEN '—' ELSE '$' || format('{:,}', CAST(round(house_size * 1000) AS BIGINT)) END AS label
           FROM sales""",
    ),
)
def usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select("sale_key", usd_label(F.col("house_size") * 1000).alias("label"))
