"""Calibration tables: predictions in bins next to what really came out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.operators.ranking import qcut


def quantile_bins(df: DataFrame, key: str, actual: str = "price", prediction: str = "pred_model", bins: int = 20) -> DataFrame:
    """Equal-frequency bins of the prediction: size, mean prediction and actual, prediction range."""
    complete = df.select(key, actual, prediction).filter(F.col(actual).isNotNull() & F.col(prediction).isNotNull())
    return _summary(qcut(complete, prediction, key, bins), actual, prediction)


def _summary(binned: DataFrame, actual: str, prediction: str) -> DataFrame:
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(prediction).alias("mean_pred"),
        F.avg(actual).alias("mean_actual"),
        F.min(prediction).alias("min_pred"),
        F.max(prediction).alias("max_pred"),
    )


def equal_width_bins(
    df: DataFrame, actual: str = "price", prediction: str = "pred_model", bins: int = 20, drop_maximum: bool = False
) -> DataFrame:
    """Equal-width bins between the smallest and largest prediction; empty bins are absent.

    The largest prediction belongs to the last bin. ``drop_maximum`` leaves it out,
    as half-open bins would.
    """
    extent = df.agg(F.min(prediction).alias("low"), F.max(prediction).alias("high")).first()
    low, high = F.lit(extent["low"]).cast("double"), F.lit(extent["high"]).cast("double")
    step = (high - low) / F.lit(bins)
    value = F.col(prediction)
    guess = F.when(step > 0, F.floor((value - low) / step)).otherwise(F.lit(bins)).cast("int")

    def edge(i: Column) -> Column:
        return F.when(i >= bins, high).otherwise(low + i * step)

    # the division may round across an edge, so the edges themselves decide
    number = F.when(value < edge(guess), guess - 1).when(value >= edge(guess + 1), guess + 1).otherwise(guess)
    number = F.when(value == high, F.lit(bins)).otherwise(number)
    binned = df.filter(value.isNotNull()).withColumn("bin", number.cast("int"))
    if drop_maximum:
        binned = binned.filter(F.col("bin") < bins)
    else:
        binned = binned.withColumn("bin", F.least(F.col("bin"), F.lit(bins - 1)))
    return _summary(binned, actual, prediction)


def ece_weighted(bins: DataFrame) -> DataFrame:
    """Calibration error in dollars and relative to each bin's mean actual, weighted by bin size."""
    gap = F.abs(F.col("mean_pred") - F.col("mean_actual"))
    return bins.agg(
        F.count(F.lit(1)).alias("bins"),
        (F.sum(F.col("n") * gap) / F.sum("n")).alias("ECE_abs"),
        (F.sum(F.col("n") * gap / F.greatest(F.col("mean_actual"), F.lit(1e-9))) / F.sum("n")).alias("ECE_rel"),
        F.sum("n").alias("total_points"),
    )


def ece_percent(bins: DataFrame, df: DataFrame, actual: str = "price") -> DataFrame:
    """Calibration error in dollars, and in percent of the mean actual over all rows."""
    gap = F.abs(F.col("mean_pred") - F.col("mean_actual"))
    mean_actual = df.agg(F.avg(actual)).scalar()
    out = bins.agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("ECE_abs"))
    return out.withColumn("ECE_percent", F.lit(100.0) * F.col("ECE_abs") / mean_actual)
