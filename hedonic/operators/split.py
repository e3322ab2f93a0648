"""Time splits as a ``split`` column on one lazy frame, and protections against leakage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.functions.scalars import is_temporal, zip_light
from hedonic.operators.clean import strict_dates
from hedonic.operators.ranking import rank_first
from hedonic.session import Lookup, written

SPLIT = "split"


def part(df: DataFrame, *names: str) -> DataFrame:
    """The rows of the named splits."""
    return df.filter(F.col(SPLIT).isin(*names))


def split_counts(df: DataFrame) -> dict[str, int]:
    """Rows per split; at most three rows reach the driver."""
    return {r[SPLIT]: r["count"] for r in df.groupBy(SPLIT).count().collect()}


def require_splits(df: DataFrame, minimum: Mapping[str, int]) -> DataFrame:
    """The frame itself, or an error when a split has fewer rows than asked for."""
    counts = split_counts(df)
    for name, rows in minimum.items():
        if counts.get(name, 0) < rows:
            raise ValueError(f"{name} has too few rows after the split: {counts.get(name, 0)} < {rows}.")
    return df


def _as_cutoff(value: str | date | datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def by_cutoff(
    df: DataFrame, cutoff: str, val_cutoff: str | None = None, date_col: str = "sold_date", require_all: bool = True
) -> DataFrame:
    """Train before ``cutoff``, test from the last cutoff on, val between the two if both are given."""
    if date_col not in df.columns:
        raise KeyError(f"Column '{date_col}' not found.")
    if not is_temporal(df.schema[date_col].dataType):
        df = strict_dates(df, date_col)
    sold, first = F.col(date_col).cast("timestamp_ntz"), _as_cutoff(cutoff)
    if val_cutoff is None:
        label = F.when(sold < first, "train").when(sold >= first, "test")
        names = ["train", "test"]
    else:
        last = _as_cutoff(val_cutoff)
        if not datetime.fromisoformat(str(cutoff)) < datetime.fromisoformat(str(val_cutoff)):
            raise ValueError(f"The first cutoff must be before the second: {cutoff}, {val_cutoff}")
        label = F.when(sold < first, "train").when(sold < last, "val").when(sold >= last, "test")
        names = ["train", "val", "test"]
    out = df.withColumn(SPLIT, label)
    if require_all:
        counts = split_counts(out)
        if counts.get(None):
            raise ValueError(f"Found {counts[None]} rows without a date in '{date_col}'. Drop them before splitting.")
        if not all(counts.get(n) for n in names):
            raise ValueError(f"The split has an empty part: {counts}. Choose other cutoffs.")
    return out


def by_year(
    df: DataFrame, train_max_year: int, val_year: int, test_min_year: int, date_col: str = "sold_date", require_all: bool = False
) -> DataFrame:
    """Train up to a year, val one year, test from a year on; other rows are dropped."""
    year = F.year(date_col)
    label = F.when(year <= train_max_year, "train").when(year == val_year, "val").when(year >= test_min_year, "test")
    out = df.withColumn(SPLIT, label).filter(F.col(SPLIT).isNotNull())
    return require_splits(out, {"train": 1, "val": 1, "test": 1}) if require_all else out


def hashed(key: Column, seed: int = 0) -> Column:
    """A number from 0 to 2**60 - 1 drawn from a key: the first 15 hexadecimal digits of an MD5 of key and seed."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sorted_parts(df: DataFrame, date_col: str = "sold_date", key: str = "sale_key", position: str = "position") -> DataFrame:
    """Each row with its 1-based place in its split, by date and then key."""
    ranked = rank_first(df, [SPLIT, date_col, key], "_rank")
    first = ranked.groupBy(F.col(SPLIT).alias("_s")).agg(F.min("_rank").alias("_first"))
    # one row per split
    placed = ranked.join(F.broadcast(first), F.col(SPLIT).eqNullSafe(F.col("_s")))
    return placed.withColumn(position, F.col("_rank") - F.col("_first") + 1).drop("_s", "_first", "_rank")


def by_hash(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 0) -> DataFrame:
    """A random split for tables without dates: stable per key, whatever the partitioning."""
    share = F.pmod(hashed(F.col(key), seed), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.withColumn(SPLIT, F.when(share < test_size, "test").otherwise("train"))


def no_cross_entity(df: DataFrame, entity: str, prefer: str = "train", three_way: bool = True) -> DataFrame:
    """Keep an entity that occurs in several splits on one side only.

    Train wins over val (or val over train, with another ``prefer``), and both win
    over test; in a two-way split ``prefer`` decides between train and test. One
    pre-aggregated pass finds the entities on more than one side, and only these
    are joined back. Rows without an entity stay. The rows are written once for the two passes.
    """
    return _one_side_only(written(df, "entities"), entity, prefer, three_way)


def _one_side_only(df: DataFrame, entity: str, prefer: str = "train", three_way: bool = True) -> DataFrame:
    key = F.col(entity).cast("string")
    has = [F.max(F.col(SPLIT) == s).alias(f"_{s}") for s in ("train", "val", "test")]
    sides = df.filter(key.isNotNull()).groupBy(key.alias("_entity")).agg(*has)
    earlier_and_test = (F.col("_train") | F.col("_val")) & F.col("_test")
    if prefer == "train":
        losers = [("val", F.col("_train") & F.col("_val")), ("test", earlier_and_test)]
    elif three_way:
        losers = [("train", F.col("_train") & F.col("_val")), ("test", earlier_and_test)]
    else:
        losers = [("train", F.col("_train") & F.col("_test"))]
    loses = F.array_compact(F.array(*[F.when(condition, F.lit(side)) for side, condition in losers]))
    unwanted = Lookup(sides.select("_entity", F.explode(loses).alias("_side")))
    return df.join(unwanted.side, (key == F.col("_entity")) & (F.col(SPLIT) == F.col("_side")), "left_anti")


def shared_entities(df: DataFrame, entity: str, a: str = "train", b: str = "test") -> DataFrame:
    """The entities that occur in both splits, as text."""
    key = F.col(entity).cast("string")
    sides = df.filter(key.isNotNull()).groupBy(key.alias(entity))
    both = sides.agg(F.max(F.col(SPLIT) == a).alias("_a"), F.max(F.col(SPLIT) == b).alias("_b"))
    return both.filter(F.col("_a") & F.col("_b")).select(entity)


def keep_test_zips(df: DataFrame, prefixes: Iterable[str], zip_col: str = "zip_code") -> DataFrame:
    """Drop test rows whose ZIP starts with none of the prefixes; no prefixes, no restriction."""
    prefixes = list(prefixes or [])
    if not prefixes or zip_col not in df.columns:
        return df
    text = zip_light(F.col(zip_col), df.schema[zip_col].dataType)
    matches = F.lit(False)
    for p in prefixes:
        matches = matches | F.coalesce(text.startswith(p), F.lit(False))
    return df.filter((F.col(SPLIT) != "test") | matches)


def from_settings(df: DataFrame, settings: Mapping[str, Any], date_col: str = "sold_date") -> tuple[str, DataFrame]:
    """The split that the ``split`` section describes, with its protections; its kind and the frame.

    ``sort_output`` adds each row's ``position`` by date and the unique column ``sort_key``.
    """
    section = settings.get("split", {}) or {}
    cutoff, val_cutoff = section.get("cutoff"), section.get("val_cutoff")
    if cutoff is None:
        raise KeyError("split.cutoff is required.")
    # the counts and the protections each read the rows: they are made once
    out = by_cutoff(written(df, "unsplit"), cutoff, val_cutoff or None, date_col)
    if section.get("forbid_property_cross_split") and section.get("property_id_col") in df.columns:
        out = _one_side_only(out, section["property_id_col"], three_way=bool(val_cutoff))
    out = keep_test_zips(out, section.get("restrict_test_zip_prefixes") or [])
    minimum = {s: int(section[f"min_{s}_rows"]) for s in ("train", "val", "test") if section.get(f"min_{s}_rows") is not None}
    if not val_cutoff:
        minimum.pop("val", None)
    out = require_splits(out, minimum) if minimum else out
    if section.get("sort_output"):
        out = sorted_parts(out, date_col, section["sort_key"])
    return ("3way" if val_cutoff else "2way"), out


def coverage(df: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rows per split next to all rows: parts are disjoint by construction, so the sum must match."""
    parts = labelled.agg(
        *[F.count_if(F.col(SPLIT) == s).alias(f"{s}_rows") for s in ("train", "val", "test")],
        F.count(F.lit(1)).alias("labelled_rows"),
    )
    total = df.agg(F.count(F.lit(1)).alias("all_rows"))
    covered = F.col("train_rows") + F.col("val_rows") + F.col("test_rows") == F.col("all_rows")
    return parts.select("*", total.scalar().alias("all_rows")).withColumn("covers_all", covered)


def downsample_train(df: DataFrame, rows: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``rows`` training rows, chosen by hashed key; other splits stay whole.

    The choice is a distributed ranking, so no task or driver holds the sample.
    """
    train, others = part(df, "train"), df.filter(F.col(SPLIT) != "train")
    ranked = rank_first(train.select(F.col(key).alias("_key")), [hashed(F.col("_key"), seed), F.col("_key")], "_rank")
    chosen = Lookup(ranked.filter(F.col("_rank") <= rows).select("_key"))
    return train.join(chosen.side, F.col(key) == F.col("_key"), "left_semi").unionByName(others)
