"""Row and value cleaning. Rules are lists of predicates, so they can be applied or counted."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.functions.scalars import (
    clip,
    finite,
    is_numeric,
    is_temporal,
    parse_price,
    parse_timestamp,
    trimmed,
    zip_normalize,
)
from hedonic.operators.quantiles import column_quantiles

ZIP_COLUMNS = ("zip_code", "zipcode", "zip")
PLACE_COLUMNS = ("city", "state")


def trim_places(df: DataFrame) -> DataFrame:
    """City and state as trimmed text; a missing one stays NULL."""
    return df.withColumns({c: trimmed(F.col(c)) for c in PLACE_COLUMNS if c in df.columns})


def normalize_zips(df: DataFrame) -> DataFrame:
    return df.withColumns({c: zip_normalize(F.col(c), df.schema[c].dataType) for c in ZIP_COLUMNS if c in df.columns})


def inf_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN and infinities in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(F.col(c)) for c in floats}) if floats else df


def coerce_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse the given columns, where present, to timestamps without time zone."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_timestamp(F.col(c), df.schema[c].dataType) for c in present}) if present else df


def coerce_date_columns(df: DataFrame) -> DataFrame:
    """Parse every column that is named like a date or already is one."""
    return coerce_dates(df, [f.name for f in df.schema.fields if "date" in f.name.lower() or is_temporal(f.dataType)])


def strict_dates(df: DataFrame, column: str = "sold_date") -> DataFrame:
    """Parse ``column``, or fail when a value is missing or is no date (one counting pass)."""
    if column not in df.columns:
        raise KeyError(f"Column '{column}' not found.")
    out = df.withColumn(column, parse_timestamp(F.col(column), df.schema[column].dataType))
    counts = df.select(F.col(column).alias("raw"), parse_timestamp(F.col(column), df.schema[column].dataType).alias("parsed")).agg(
        F.count_if(F.col("raw").isNull()).alias("missing"),
        F.count_if(F.col("raw").isNotNull() & F.col("parsed").isNull()).alias("bad"),
    ).first()
    if counts["bad"]:
        raise ValueError(f"Column '{column}' is not datetime-like: {counts['bad']} values could not be parsed.")
    if counts["missing"]:
        raise ValueError(f"Found {counts['missing']} rows without a date in '{column}'. Drop them before splitting.")
    return out


def clean_price(df: DataFrame, column: str = "price") -> DataFrame:
    return df.withColumn(column, parse_price(F.col(column), df.schema[column].dataType))


def range_filter(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows whose value lies within the limits; a missing value is outside any limit."""
    if column not in df.columns:
        return df
    if low is not None:
        df = df.filter(F.col(column) >= low)
    if high is not None:
        df = df.filter(F.col(column) <= high)
    return df


def percentile_cap(df: DataFrame, column: str, max_percentile: float | None = None, min_percentile: float | None = None) -> DataFrame:
    """Limit values to exact percentiles of the column, both taken before either is applied."""
    return apply_filters(df, {column: {"max_percentile": max_percentile, "min_percentile": min_percentile}})


def apply_filters(df: DataFrame, filters: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Range filter and percentile cap column by column, in the given order.

    The order matters: a cap is computed on the rows that the columns before left. All
    percentiles come from one fit nevertheless: the values of a column count in it where
    the row passes the ranges up to that column, and a cap changes no other column's range.
    """
    kept, counted, capped = F.lit(True), {}, {}
    for column, spec in filters.items():
        if column not in df.columns:
            continue
        if spec.get("min") is not None:
            kept = kept & (F.col(column) >= spec["min"])
        if spec.get("max") is not None:
            kept = kept & (F.col(column) <= spec["max"])
        wanted = [spec[p] for p in ("max_percentile", "min_percentile") if spec.get(p) is not None]
        if wanted and is_numeric(df.schema[column].dataType):
            counted[column], capped[column] = F.when(kept, F.col(column)).alias(column), wanted
    if capped:
        percentiles = sorted({p for wanted in capped.values() for p in wanted})
        limits = column_quantiles(df.select(*counted.values()), list(capped), [p / 100.0 for p in percentiles])
    df = df.filter(kept)
    for column in capped:
        limit, spec = dict(zip(percentiles, limits[column])), filters[column]
        df = df.withColumn(column, clip(clip(F.col(column), high=limit.get(spec.get("max_percentile"))), low=limit.get(spec.get("min_percentile"))))
    return df


def winsor_limits(df: DataFrame, columns: list[str], lower_pct: float = 0.0, upper_pct: float = 99.0) -> dict[str, list[float | None]]:
    """The exact lower and upper percentile of each numeric column, in one fit."""
    numeric = [c for c in columns if c in df.columns and is_numeric(df.schema[c].dataType)]
    return column_quantiles(df, numeric, [lower_pct / 100.0, upper_pct / 100.0]) if numeric else {}


def winsorize(
    df: DataFrame, columns: list[str], lower_pct: float = 0.0, upper_pct: float = 99.0, fit_on: DataFrame | None = None
) -> DataFrame:
    """Clip columns to their percentiles over ``fit_on`` (all rows, or the training rows)."""
    limits = winsor_limits(fit_on if fit_on is not None else df, columns, lower_pct, upper_pct)
    return df.withColumns({c: clip(F.col(c).cast("double"), low, high) for c, (low, high) in limits.items()}) if limits else df


def sanity_rules(
    df: DataFrame,
    bed_col: str = "bed",
    bath_col: str = "bath",
    house_size_col: str = "house_size",
    max_bath_to_bed_ratio: float = 5.0,
    min_house_size: float = 100.0,
) -> list[tuple[str, Column]]:
    """Predicates for rows to keep; a comparison with a missing value does not drop the row."""
    rules = []
    if bed_col in df.columns and bath_col in df.columns:
        bed, bath = F.col(bed_col).try_cast("double"), F.col(bath_col).try_cast("double")
        bad = (bath > bed * max_bath_to_bed_ratio) | ((bed == 0) & (bath > 0))
        rules.append(("bath_vs_bed", ~F.coalesce(bad, F.lit(False))))
    if house_size_col in df.columns:
        tiny = F.col(house_size_col).try_cast("double") <= min_house_size
        rules.append(("house_size", ~F.coalesce(tiny, F.lit(False))))
    return rules


def sanity_drop(df: DataFrame, **options: Any) -> DataFrame:
    for _, keep in sanity_rules(df, **options):
        df = df.filter(keep)
    return df


def date_rules(df: DataFrame, raw: str, parsed: str = "sold_date") -> list[tuple[str, Column]]:
    """Two steps: rows with any text for the date, then rows whose text was understood."""
    given = F.col(raw).isNotNull() & (F.trim(F.col(raw).cast("string")) != "")
    return [(f"{parsed} given", given), (f"{parsed} understood", F.col(parsed).isNotNull())]


def filter_rules(df: DataFrame, filters: Mapping[str, Mapping[str, Any]]) -> list[tuple[str, Column]]:
    """The range limits as predicates for rows to keep."""
    rules = []
    for column, spec in filters.items():
        if column in df.columns:
            if "min" in spec:
                rules.append((f"{column}>=min", F.col(column) >= spec["min"]))
            if "max" in spec:
                rules.append((f"{column}<=max", F.col(column) <= spec["max"]))
    return rules


def audit_rules(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows before and after each rule when they are applied in order, counted in one pass."""
    kept = F.lit(True)
    counts = [F.count(F.lit(1)).alias("k0")]
    for i, (_, keep) in enumerate(rules, 1):
        kept = kept & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(kept).alias(f"k{i}"))
    steps = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"k{i - 1}").alias("rows_before"), F.col(f"k{i}").alias("rows_after"))
            for i, (name, _) in enumerate(rules, 1)
        ]
    )
    return df.agg(*counts).select(F.inline(steps))
