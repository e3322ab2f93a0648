"""Queries over run outputs: written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators import metrics
from hedonic.operators.profile import na_summary
from hedonic.plans.flagship import rounded
from hedonic.plans.q_evaluation import BIN_COLUMNS, BOTH, QUANTILE_BINS, SLICES_MULTI, _ERRORS, _metric_sql, both, multi_slices, quantile_bins_of
from hedonic.plans.q_profile import na_sql
from hedonic.plans.registry import query
from hedonic.plans.sales import over, split_sales
from hedonic.session import durable, scratch_path
from hedonic.sinks.runs import RunStore


def store(spark: SparkSession, run_id: str = "2025-01-02_000000") -> RunStore:
    return RunStore(spark, scratch_path(spark, "runs"), run_id)


@query(
    "snk_predictions",
    over(
        "splits",
        """SELECT split, 'formula' AS family, state, count(*) AS n, round(sum(price), 3) AS price, round(sum(pred_baseline), 3) AS pred_baseline,
                  round(sum(pred_model), 3) AS pred_model FROM evl GROUP BY split, state""",
        *BOTH,
    ),
)
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, df = store(spark), both(spark, sf_dir)
    for name in ("val", "test"):
        runs.predictions(df.filter(F.col("split") == name).drop("split"), name, "formula")
    sums = [F.sum(c).alias(c) for c in ("price", "pred_baseline", "pred_model")]
    out = runs.read("predictions").groupBy("split", "family", "state").agg(F.count(F.lit(1)).alias("n"), *sums)
    return rounded(out, 3, "price", "pred_baseline", "pred_model")


_SUMMARY = f"""summary AS (
    SELECT 'baseline' AS model_family, 'median_by_zip_year' AS model_name, split, {_metric_sql('pred_baseline')} FROM evl GROUP BY split
    UNION ALL SELECT 'formula', 'formula', split, {_metric_sql('pred_model')} FROM evl GROUP BY split)"""


def summary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.compare_predictions(both(spark, sf_dir), {"baseline": "pred_baseline", "formula": "pred_model"}, by=["split"])
    name = F.when(F.col("model") == "baseline", "median_by_zip_year").otherwise(F.col("model"))
    out = table.select(F.col("model").alias("model_family"), name.alias("model_name"), "split", "MAE", "RMSE", "R2")
    return rounded(rounded(out, 4, "MAE", "RMSE"), 8, "R2")


@query(
    "snk_metrics",
    over(
        "splits",
        " UNION ALL ".join(f"""SELECT '2025-01-02_000000' AS run_id, model_family AS family, split, '{m}' AS metric, "{m}" AS value FROM summary""" for m in ("MAE", "RMSE", "R2")),
        *BOTH,
        _SUMMARY,
    ),
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark).metrics(summary_of(spark, sf_dir).withColumnRenamed("model_family", "family"))


@query("snk_summary", over("splits", "SELECT * FROM summary", *BOTH, _SUMMARY))
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark).summary(summary_of(spark, sf_dir)).drop("run_id")


@query("snk_slices", over("preds", SLICES_MULTI, _ERRORS))
def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark).slices(multi_slices(spark, sf_dir)).drop("run_id")


@query("snk_calibration", over("preds", f"SELECT {BIN_COLUMNS} FROM bins", *QUANTILE_BINS))
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = store(spark).calibration(quantile_bins_of(spark, sf_dir)).drop("run_id")
    return rounded(out, 4, "mean_pred", "mean_actual", "min_pred", "max_pred")


@query(
    "snk_run_layout",
    over(
        "splits",
        """SELECT run_id, CAST(split AS STRING) AS split, count(*) AS n FROM splits, (VALUES ('2025-01-01_000000'), ('2025-01-02_000000')) v(run_id)
           GROUP BY run_id, split""",
    ),
)
def run_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs side by side; writing one again leaves the other alone."""
    base, counts = scratch_path(spark, "runs"), durable(split_sales(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n")))
    for run_id in ("2025-01-01_000000", "2025-01-02_000000", "2025-01-01_000000"):
        last = RunStore(spark, base, run_id)
        last.write("counts", counts)
    return last.read("counts").select("run_id", "split", "n")


@query("snk_latest_run", over("splits", "SELECT '2025-01-03_000000' AS run_id, split, count(*) AS n FROM splits GROUP BY split"))
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, counts = scratch_path(spark, "runs"), durable(split_sales(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n")))
    for run_id in ("2025-01-03_000000", "2025-01-02_000000"):
        runs = RunStore(spark, base, run_id)
        runs.write("counts", counts)
    return runs.latest("counts").select("run_id", "split", "n")


_OVERVIEW = ["bed", "bath", "house_size", "city", "prev_sold_date"]


@query("snk_run_overview", over("splits", na_sql("splits", _OVERVIEW, "split")))
def run_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = na_summary(split_sales(spark, sf_dir), _OVERVIEW, by=["split"])
    return rounded(store(spark).overview(overview).drop("run_id"), 6, "na_pct")
