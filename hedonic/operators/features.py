"""Row-wise features: each value depends on its own row only, so none can leak."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.functions.scalars import elapsed_days, is_temporal, parse_timestamp, season

# The engineered features of the usual settings, as Spark SQL expressions.
STANDARD_EXPRESSIONS = [
    {"name": "bed_per_bath", "expr": "bed / CASE WHEN bath < 1 THEN 1 ELSE bath END"},
    {"name": "lot_per_size", "expr": "acre_lot / CASE WHEN house_size < 1 THEN 1 ELSE house_size END"},
    {"name": "log_house_size", "expr": "log1p(house_size)"},
]


def _dated(df: DataFrame, date_col: str) -> None:
    if date_col not in df.columns:
        raise KeyError(f"Column '{date_col}' is required to derive time features.")
    if not is_temporal(df.schema[date_col].dataType):
        raise TypeError(f"'{date_col}' must be a date or timestamp column.")


def calendar_features(df: DataFrame, date_col: str = "sold_date") -> DataFrame:
    """Add year, month, season and, where ``year_built`` exists, property_age."""
    _dated(df, date_col)
    out = df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})
    out = out.withColumn("season", season(F.col("month")))
    if "year_built" in df.columns:
        age = F.col("year") - F.col("year_built").try_cast("int")
        out = out.withColumn("property_age", F.when(age >= 0, age))
    return out


def years_since_previous(df: DataFrame, date_col: str = "sold_date", previous_col: str = "prev_sold_date") -> DataFrame:
    """Add years_since_prev_sale: whole days since the previous sale over 365.25."""
    _dated(df, date_col)
    if previous_col not in df.columns:
        return df.withColumn("years_since_prev_sale", F.lit(None).cast("double"))
    previous = parse_timestamp(F.col(previous_col), df.schema[previous_col].dataType)
    return df.withColumn("years_since_prev_sale", elapsed_days(F.col(date_col), previous) / F.lit(365.25))


def time_features(df: DataFrame) -> DataFrame:
    return years_since_previous(calendar_features(df))


def ensure_year(df: DataFrame, date_col: str = "sold_date") -> DataFrame:
    """Add year from the date unless it is there or cannot be derived."""
    if "year" in df.columns or date_col not in df.columns or not is_temporal(df.schema[date_col].dataType):
        return df
    return df.withColumn("year", F.year(date_col))


def add_expressions(df: DataFrame, expressions: Sequence[Mapping[str, str]]) -> DataFrame:
    """Add columns from Spark SQL expressions in order; later ones may use earlier ones."""
    for item in expressions:
        name, expr = item.get("name"), item.get("expr")
        if not name or not isinstance(name, str):
            raise ValueError(f"Expression without a valid name: {dict(item)!r}")
        if not expr or not isinstance(expr, str):
            raise ValueError(f"Feature '{name}' has no valid expression.")
        try:
            df = df.withColumn(name, F.expr(expr))
        except ParseException as e:
            raise RuntimeError(f"Feature '{name}' cannot be computed from '{expr}': {e}") from e
        except AnalysisException as e:
            if "UNRESOLVED_COLUMN" in str(e) or "UNRESOLVED_ROUTINE" in str(e):
                raise NameError(f"Feature '{name}' uses an unknown column or function: {e}") from e
            raise RuntimeError(f"Feature '{name}' cannot be computed from '{expr}': {e}") from e
    return df


def usable_columns(train: DataFrame, wanted: Sequence[str], *others: DataFrame) -> list[str]:
    """The wanted columns that all frames have and that hold a value in training (one pass)."""
    shared = [c for c in wanted if c in train.columns and all(c in o.columns for o in others)]
    if not shared:
        raise ValueError("No usable features: none of the wanted columns is in every frame.")
    seen: list[Column] = [F.max(F.col(c).isNotNull()).alias(c) for c in shared]
    row = train.agg(*seen).first()
    usable = [c for c in shared if row[c]]
    if not usable:
        raise ValueError("No usable features: every wanted column is empty in training.")
    return usable
