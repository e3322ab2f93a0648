"""The whole way from a raw sales table to a clean one, driven by a settings mapping."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from hedonic.operators import clean
from hedonic.session import written
from hedonic.sources import schema


def load_sales(raw: DataFrame, settings: Mapping[str, Any] | None = None, require_date: bool = True) -> DataFrame:
    """Names, aliases, dates, price, filters, sanity rules and winsorizing, in this order.

    ``settings`` has the sections ``data`` (required_columns, parse_dates,
    drop_na_target, filters, sanity), ``target`` (name) and ``features`` (winsorize).
    """
    settings = settings or {}
    data, target = settings.get("data", {}), settings.get("target", {}).get("name", "price")
    df = schema.normalize_names(raw)
    df = clean.normalize_zips(clean.trim_places(df))
    df = schema.resolve_aliases(df)
    df = schema.date_from_parts(schema.detect_date(df))
    df = clean.coerce_dates(df, list(dict.fromkeys([*data.get("parse_dates", []), "sold_date", "prev_sold_date"])))
    df = clean.inf_to_null(df)
    df = schema.detect_price(df)
    if "price" in df.columns:
        df = clean.clean_price(df)
    if "sold_date" in df.columns:
        df = df.na.drop(subset=["sold_date"])
    df = schema.require_columns(df, tuple(data.get("required_columns", ("price", "sold_date"))), require_date)
    if data.get("drop_na_target", True):
        if target not in df.columns:
            raise ValueError(f"Target column '{target}' not found.")
        df = df.na.drop(subset=[target])
    filters = data.get("filters", {})
    winsor = settings.get("features", {}).get("winsorize", {})
    caps = any("max_percentile" in spec or "min_percentile" in spec for spec in filters.values())
    if caps or winsor.get("enabled", False):
        # percentiles take several passes: parse the text once, not once per pass
        df = written(df, "parsed")
    df = clean.apply_filters(df, filters)
    sanity = dict(data.get("sanity", {}))
    if sanity.pop("enabled", True):
        df = clean.sanity_drop(df, **sanity)
    if winsor.get("enabled", False):
        df = clean.winsorize(df, list(winsor.get("columns", [])), winsor.get("lower_pct", 0.0), winsor.get("upper_pct", 99.0))
    return schema.require_rows(df)
