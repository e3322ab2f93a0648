"""The log target and the way back to dollars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extract_target(df: DataFrame, target: str = "price") -> DataFrame:
    if target not in df.columns:
        raise KeyError(f"Target column '{target}' not found.")
    return df.select(target)


def log_target(df: DataFrame, target: str = "price", column: str = "label", log: bool = True) -> DataFrame:
    """Add log1p of the target; a negative target is an error when its row is evaluated."""
    y = F.col(target).cast("double")
    if not log:
        return df.withColumn(column, y)
    negative = F.raise_error(F.lit("negative target values cannot be log-transformed")).cast("double")
    return df.withColumn(column, F.when(y < 0, negative).otherwise(F.log1p(y)))


def smear_factor(df: DataFrame, label: str = "label", prediction: str = "prediction", log: bool = True, smearing: bool = True) -> float | None:
    """Mean of exp(residual) over the fitted rows; 1 without rows, none without a log target."""
    if not (log and smearing):
        return None
    value = df.agg(F.avg(F.exp(F.col(label) - F.col(prediction))).alias("smear")).first()["smear"]
    return 1.0 if value is None else float(value)


def to_dollars(prediction: Column, smear: Column | float | None = None, log: bool = True) -> Column:
    """expm1 of a log prediction, times the smear factor when that is finite."""
    if not log:
        return prediction
    dollars = F.expm1(prediction)
    if smear is None:
        return dollars
    factor = F.lit(smear) if isinstance(smear, (int, float)) else smear
    usable = factor.isNotNull() & (factor > float("-inf")) & (factor < float("inf"))
    return F.when(usable, dollars * factor).otherwise(dollars)
