"""Group medians fitted on training rows and attached elsewhere, and the median baseline.

Fitting yields small tables (``Lookup``); applying joins them. All levels of a fit
are computed together: each row counts once per level, in one set of passes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hedonic.functions.scalars import zip_normalize
from hedonic.operators.features import ensure_year
from hedonic.operators.quantiles import exact_quantiles
from hedonic.session import Lookup, durable, join_lookup, row_bytes


def group_medians(df: DataFrame, keys: list[str], target: str, min_group_size: int = 1, keep_null_keys: bool = True) -> DataFrame:
    """Median and row count per group with at least ``min_group_size`` rows."""
    if not keep_null_keys and keys:
        df = df.na.drop(subset=keys)
    stats = exact_quantiles(df, target, [0.5], keys, ["median"])
    return stats.filter(F.col("n_rows") >= min_group_size).select(*keys, "median", F.col("n_rows").alias("n"))


def median_levels(df: DataFrame, levels: list[list[str]], target: str) -> DataFrame:
    """Medians for several key sets at once: columns ``level``, all keys, ``median``, ``n``."""
    keys = list(dict.fromkeys(k for level in levels for k in level))
    stats = exact_quantiles(df, target, [0.5], keys, ["median"], levels)
    return stats.select("level", *keys, "median", F.col("n_rows").alias("n"))


def _rows_per_level(stats: DataFrame, min_group_size: int) -> dict[int, tuple[int, float | None, int]]:
    """For each level the number of groups that are large enough, its largest median, and the bytes of all its groups.

    The level without keys has one group, so there this is the overall median.
    """
    enough = F.count_if(F.col("n") >= min_group_size).alias("groups")
    found = stats.groupBy("level").agg(enough, F.max("median").alias("median"), F.sum(row_bytes(stats)).alias("size")).collect()
    return {r["level"]: (r["groups"], r["median"], r["size"]) for r in found}


def global_median(df: DataFrame, target: str) -> float | None:
    return exact_quantiles(df, target, [0.5], [], ["median"]).first()["median"]


# --- neighbour statistics -----------------------------------------------------


@dataclass
class NeighborFit:
    """Medians of a target per (ZIP, year), per ZIP and overall, fitted on training rows."""

    group_keys: list[str]
    medians: Lookup
    by_zip: Lookup
    overall: float | None
    name: str
    fill: str


def fit_neighbor_stats(
    train: DataFrame, stats: Mapping[str, str], group_keys: list[str] | None = None, min_group_size: int = 50, fill: str = "global_median"
) -> list[NeighborFit]:
    """One fit for several statistics, given as name -> column; all share the keys and one set of passes."""
    keys = list(group_keys or ["zip_code", "year"])
    if "year" not in keys:
        raise KeyError("'year' must be among the group keys.")
    for name, of in stats.items():
        for c in [*keys, of]:
            if c not in train.columns:
                raise KeyError(f"'{c}' is missing, so {name} cannot be fitted.")
    has_zip = "zip_code" in train.columns
    places = ["zip_code"] if has_zip else keys
    columns = list(dict.fromkeys([*keys, *(["zip_code"] if has_zip else [])]))
    targets = list(dict.fromkeys(stats.values()))
    values = F.array(*[F.struct(F.lit(t).alias("_of"), F.col(t).cast("double").alias("_value")) for t in targets])
    long = train.select(*columns, F.inline(values))
    table = durable(median_levels(long, [["_of", *keys], ["_of", *places], ["_of"]], "_value"))
    groups = F.count_if(F.col("n") >= 1).alias("groups")
    stated = [groups, F.max("median").alias("median"), F.sum(row_bytes(table)).alias("size")]
    sizes = {(r["_of"], r["level"]): r for r in table.groupBy("_of", "level").agg(*stated).collect()}  # a row per column and level
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    zip_key = F.col("zip_code") if has_zip else F.lit(None).cast("string")
    fits = {}
    for of in targets:
        own = table.filter(F.col("_of") == of)
        medians = own.filter((F.col("level") == 0) & full & (F.col("n") >= min_group_size)).select(*keys, "median")
        by_zip = own.filter((F.col("level") == 1) & zip_key.isNotNull()).select(zip_key.alias("zip_code"), F.col("median").alias("_zip"))
        found = [(sizes[of, i]["groups"], sizes[of, i]["size"]) if (of, i) in sizes else (0, 0) for i in (0, 1)]
        overall = sizes[of, 2]["median"] if (of, 2) in sizes else None
        fits[of] = (Lookup(medians, *found[0]), Lookup(by_zip, *found[1]), overall)
    return [NeighborFit(keys, *fits[of], name, fill) for name, of in stats.items()]


def fit_neighbors(
    train: DataFrame,
    target: str = "price",
    group_keys: list[str] | None = None,
    name: str = "zip_year_price_median",
    min_group_size: int = 50,
    fill: str = "global_median",
) -> NeighborFit:
    return fit_neighbor_stats(train, {name: target}, group_keys, min_group_size, fill)[0]


def _filled(df: DataFrame, fit: NeighborFit, column: str) -> DataFrame:
    if fit.fill == "zip_median" and "zip_code" in df.columns:
        joined = join_lookup(df, fit.by_zip, ["zip_code"])
        return joined.withColumn(column, F.coalesce(F.col(column), F.col("_zip"))).drop("_zip")
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(fit.overall).cast("double")))


def _attach(df: DataFrame, fit: NeighborFit, lookup: Lookup, column: str) -> DataFrame:
    joined = join_lookup(df.drop(column), lookup, fit.group_keys).withColumnRenamed("median", column)
    return _filled(joined, fit, column)


def attach_previous_year(df: DataFrame, fit: NeighborFit, column: str | None = None) -> DataFrame:
    """For training rows: the median of the same group one year earlier."""
    shifted = Lookup(fit.medians.table.withColumn("year", F.col("year") + 1), fit.medians.rows, fit.medians.size)
    return _attach(df, fit, shifted, column or f"{fit.name}_prev")


def attach_same_year(df: DataFrame, fit: NeighborFit, column: str | None = None) -> DataFrame:
    """For later rows: the training median of the very same group."""
    return _attach(df, fit, fit.medians, column or fit.name)


def carried_forward(fit: NeighborFit, years: DataFrame) -> DataFrame:
    """The latest known median for each of the given groups.

    ``years`` holds distinct group keys, so a window partition has one row per
    known or asked-for year of a place, never the sales themselves.
    """
    places = [k for k in fit.group_keys if k != "year"]
    known = fit.medians.table.select(*fit.group_keys, "median", F.lit(False).alias("_asked"))
    asked = years.select(*fit.group_keys, F.lit(None).cast("double").alias("median"), F.lit(True).alias("_asked"))
    upto = Window.partitionBy(*places).orderBy("year", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    latest = known.unionByName(asked).withColumn("median", F.last("median", ignorenulls=True).over(upto))
    return latest.filter("_asked").drop("_asked")


def attach_asof(df: DataFrame, fit: NeighborFit, column: str | None = None) -> DataFrame:
    """For later rows: the group's last training median up to the row's year."""
    latest = carried_forward(fit, df.select(*fit.group_keys).distinct())
    return _attach(df, fit, Lookup(latest), column or fit.name)


ATTACH = {"exact": attach_same_year, "asof": attach_asof, "prev": attach_previous_year}


def neighbors_from_settings(
    train: DataFrame, other: DataFrame, settings: Mapping[str, Any], target: str = "price", mode: str = "exact", symmetric: bool = False
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Fit on train and attach the statistics the settings list; returns both frames and the new columns.

    Training rows get the previous year as ``<name>_prev`` and the others ``<name>``.
    With ``symmetric`` both get ``<name>``, so that a model can use the column.
    """
    section = settings.get("features", {}).get("leakage_safe_neighbors") or {}
    if not section.get("enabled", False):
        return train, other, []
    asked = section.get("stats", [{"kind": "median"}])
    unknown = {repr(spec.get("kind")) for spec in asked} - {"'median'"}
    if unknown:
        raise NotImplementedError(f"Only the median is supported, not {', '.join(sorted(unknown))}.")
    stats = {spec.get("name", "zip_year_price_median"): spec.get("of", target) for spec in asked}
    fits = fit_neighbor_stats(train, stats, section.get("group_keys"), int(section.get("min_group_size", 50)), section.get("fill_strategy", "global_median"))
    for fit in fits:
        train = attach_previous_year(train, fit, fit.name if symmetric else None)
        other = ATTACH[mode](other, fit, fit.name)
    return train, other, [c for name in stats for c in ([name] if symmetric else [name, f"{name}_prev"])]


# --- the median baseline ------------------------------------------------------


@dataclass
class MedianBaseline:
    """Medians per (ZIP, year), ZIP and year with enough rows, and the overall median."""

    levels: list[tuple[list[str], Lookup]]
    overall: float | None


def _baseline_keys(df: DataFrame, date_col: str) -> DataFrame:
    df = ensure_year(df, date_col)
    if "zip_code" in df.columns:
        df = df.withColumn("zip_code", zip_normalize(F.col("zip_code"), df.schema["zip_code"].dataType))
    return df


def fit_baseline(
    train: DataFrame, target: str = "price", date_col: str = "sold_date", min_group_size: int = 1, apply_columns: list[str] | None = None
) -> MedianBaseline:
    """Fit all levels; ``apply_columns`` names what the other frame has, so that missing keys drop out."""
    if target not in train.columns:
        raise KeyError(f"Target column '{target}' not found.")
    keyed = _baseline_keys(train, date_col)
    usable = set(keyed.columns)
    if apply_columns is not None:
        usable &= set(apply_columns) | ({"year"} if date_col in apply_columns else set())
    keys = [k for k in ("zip_code", "year") if k in usable]
    level_keys = ([["zip_code", "year"]] if len(keys) == 2 else []) + [[k] for k in keys] + [[]]
    stats = durable(median_levels(keyed, level_keys, target))
    rows = _rows_per_level(stats, min_group_size)
    levels = []
    for i, level in enumerate(level_keys[:-1]):
        table = stats.filter((F.col("level") == i) & (F.col("n") >= min_group_size))
        levels.append((level, Lookup(table.select(*level, F.col("median").alias(f"_m{i}")), *rows.get(i, (0, None, 0))[::2])))
    return MedianBaseline(levels, rows.get(len(level_keys) - 1, (0, None, 0))[1])


def predict_baseline(df: DataFrame, fit: MedianBaseline, column: str = "pred_baseline", date_col: str = "sold_date") -> DataFrame:
    """Add the median of the finest level that knows the row's keys."""
    columns = df.columns
    keyed = _baseline_keys(df, date_col)
    normalized = {}
    if "zip_code" in columns:  # join on the normalized ZIP, keep the given one
        keyed = df.withColumn("_zip_key", zip_normalize(F.col("zip_code"), df.schema["zip_code"].dataType))
        keyed = ensure_year(keyed, date_col)
        normalized = {"zip_code": "_zip_key"}
    for level, lookup in fit.levels:
        side = lookup.side
        on = F.lit(True)
        for k in level:
            side = side.withColumnRenamed(k, f"_lk_{k}")
            on = on & F.col(normalized.get(k, k)).eqNullSafe(F.col(f"_lk_{k}"))
        keyed = keyed.join(side, on, "left").drop(*[f"_lk_{k}" for k in level])
    medians = [F.col(f"_m{i}") for i in range(len(fit.levels))]
    return keyed.withColumn(column, F.coalesce(*medians, F.lit(fit.overall).cast("double"))).select(*columns, column)
