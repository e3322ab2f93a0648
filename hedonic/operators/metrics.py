"""Error metrics, slices, the quality gate and plot ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.functions.scalars import slice_label, zip_normalize
from hedonic.operators.clean import ZIP_COLUMNS
from hedonic.operators.quantiles import exact_quantiles


def metric_columns(actual: str, prediction: str) -> list[Column]:
    """MAE, RMSE and R2 in one pass; R2 is NULL when the actual values do not vary."""
    y, error = F.col(actual), F.col(prediction) - F.col(actual)
    # only rows with both values count, as var_pop would skip other rows than the errors do
    y = F.when(error.isNotNull(), y)
    spread = F.var_pop(y) * F.count(y)
    return [
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("R2"),
    ]


def regression_metrics(df: DataFrame, actual: str = "price", prediction: str = "pred_model", by: list[str] | None = None) -> DataFrame:
    """One row of count, MAE, RMSE and R2, or one per group of ``by``."""
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *metric_columns(actual, prediction))


def compare_predictions(df: DataFrame, predictions: dict[str, str], actual: str = "price", by: list[str] | None = None) -> DataFrame:
    """The metrics of several prediction columns side by side, as rows named by ``model``."""
    by = by or []
    models = F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("_pred")) for name, c in predictions.items()])
    long = df.select(*by, F.col(actual).cast("double").alias("_actual"), F.inline(models))
    return regression_metrics(long, "_actual", "_pred", [*by, "model"])


def beats_baseline(metrics: DataFrame, model: str = "model", baseline: str = "baseline") -> DataFrame:
    """Whether the model has both the lower MAE and the lower RMSE, from metric rows named by ``model``."""
    def of(name: str, metric: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col(metric)))

    return metrics.agg(
        of(model, "MAE").alias("model_mae"),
        of(baseline, "MAE").alias("baseline_mae"),
        of(model, "RMSE").alias("model_rmse"),
        of(baseline, "RMSE").alias("baseline_rmse"),
    ).withColumn("model_beats_baseline", (F.col("model_mae") < F.col("baseline_mae")) & (F.col("model_rmse") < F.col("baseline_rmse")))


def residuals(df: DataFrame, actual: str = "price", prediction: str = "pred_model", column: str = "residual") -> DataFrame:
    return df.withColumn(column, F.col(prediction) - F.col(actual))


def slices_single(
    df: DataFrame,
    dimensions: list[str],
    actual: str = "price",
    prediction: str = "pred_model",
    min_count: int = 10,
    topk: int = 20,
) -> DataFrame:
    """The worst ``topk`` values of each dimension by MAE, among values with enough rows.

    Values are trimmed, and ZIP columns normalised, so that ``501.0`` and ``00501`` are one.
    All dimensions are aggregated together; the rank filter lets Spark keep only
    ``topk`` rows per dimension and task before the last shuffle.
    """
    present = [d for d in dimensions if d in df.columns]
    values = {d: zip_normalize(F.col(d), df.schema[d].dataType) if d in ZIP_COLUMNS else F.trim(F.col(d).cast("string")) for d in present}
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), value.alias("value")) for d, value in values.items()])
    long = df.select(F.abs(F.col(actual) - F.col(prediction)).alias("_e"), F.inline(pairs)).filter(F.col("value").isNotNull())
    groups = long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("_e").alias("MAE"))
    worst = Window.partitionBy("dimension").orderBy(F.desc("MAE"), F.asc("value"))
    ranked = groups.filter(F.col("n") >= min_count).withColumn("rank", F.row_number().over(worst)).filter(F.col("rank") <= topk)
    return ranked.withColumn("label", slice_label(F.col("value"), F.col("n")))


def slices_multi(
    df: DataFrame,
    group_cols: list[str],
    actual: str = "price",
    prediction: str = "pred_model",
    min_count: int = 30,
    topk: int = 20,
) -> DataFrame:
    """The worst ``topk`` combinations of the columns by MAE; missing values form groups."""
    present = [c for c in group_cols if c in df.columns]
    error = F.col(actual) - F.col(prediction)
    groups = df.groupBy(*present).agg(
        F.count(F.lit(1)).alias("count"), F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE")
    )
    return groups.filter(F.col("count") >= min_count).orderBy(F.desc("MAE"), *[F.asc(c) for c in present]).limit(topk)


def plot_ranges(df: DataFrame, actual: str = "price", prediction: str = "pred_model") -> DataFrame:
    """Axis limits: p1 and p99 of actual and predicted pooled, and p99 of the absolute residual."""
    values = F.array(
        F.struct(F.lit("pooled").alias("kind"), F.col(actual).cast("double").alias("value")),
        F.struct(F.lit("pooled").alias("kind"), F.col(prediction).cast("double").alias("value")),
        F.struct(F.lit("residual").alias("kind"), F.abs(F.col(prediction) - F.col(actual)).cast("double").alias("value")),
    )
    long = df.select(F.inline(values))
    stats = exact_quantiles(long, "value", [0.01, 0.99], ["kind"], ["p1", "p99"])

    def of(kind: str, name: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(name)))

    return stats.agg(
        F.greatest(F.lit(0.0), of("pooled", "p1")).alias("axis_low"),
        (of("pooled", "p99") * 1.05).alias("axis_high"),
        (of("residual", "p99") * 1.1).alias("residual_limit"),
    )

