"""Exact quantiles per group, without gathering a group anywhere.

The built-in exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which a hot group (say a third of all rows) does not fit. Here the
wanted order statistics are found by counting, whatever the size of a group: the keys and
the value are written once; rows are counted per coarse value cell, the cells holding the
wanted ranks are looked up in the cumulative counts, and the values in these cells are
counted and ranked. Only a cell that holds very many rows is split further before that.
Every pass is a partially aggregated count; what is shuffled are counts.

Cells of one group are bounded whatever the data: a coarse cell index has fewer than
2**19 values, a split makes at most 2**16 + 1 cells, and the last step ranks the
distinct values of cells with at most ``CELL_MAX_ROWS`` rows. A coarse cell spans
2**46 doubles, so after three splits it holds a single one and the loop ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.functions.scalars import finite
from hedonic.session import BROADCAST_MAX_ROWS, durable, written

# A cell of at most this many rows goes into one window.
CELL_MAX_ROWS = 1_000_000
_CELLS_PER_OCTAVE = 64
_SPLIT = 1 << 16
_SMALLEST_EXPONENT = 1075  # doubles reach down to 2**-1074


def _coarse_cell(v: Column) -> Column:
    """A cell index that never decreases as ``v`` grows, over all finite doubles."""
    size = F.log2(F.abs(v)) + _SMALLEST_EXPONENT
    return F.when(v == 0, F.lit(0)).otherwise(F.floor(F.signum(v) * size * _CELLS_PER_OCTAVE)).cast("long")


def _wanted_ranks(n: Column, probs: list[float]) -> list[tuple[Column, Column, Column]]:
    """For each probability the two neighbouring 0-based ranks and the weight between them."""
    out = []
    for p in probs:
        position = (n - 1) * F.lit(float(p))
        low = F.floor(position).cast("long")
        out.append((low, F.ceil(position).cast("long"), position - low))
    return out


def _holds_wanted_rank(probs: list[float]) -> Column:
    """Whether the cell [_base, _base + _c) holds a rank that some probability needs."""
    ranks = [rank for low, high, _ in _wanted_ranks(F.col("_n"), probs) for rank in (low, high)]
    return reduce(lambda a, b: a | b, [(F.col("_base") <= r) & (r < F.col("_base") + F.col("_c")) for r in ranks])


def _per_level(df: DataFrame, keys: list[str], levels: list[tuple[int, list[str]]]) -> DataFrame:
    """Each row once per level, with the keys outside the level set to NULL."""
    rows = [
        F.struct(
            F.lit(i).alias("level"),
            *[(F.col(k) if k in level else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys],
        )
        for i, level in levels
    ]
    others = [c for c in df.columns if c not in keys]
    return df.select(*others, F.inline(F.array(*rows)))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    keys: list[str] | None = None,
    names: list[str] | None = None,
    levels: list[list[str]] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group of ``keys``.

    NULL keys form a group; NULL, NaN and infinite values are not ranked. Returns
    the keys, ``n_rows`` (all rows of the group), ``n_values`` (ranked rows) and
    one double per probability. A group without values has NULL quantiles.

    ``levels`` asks for several groupings at once, each by some of the keys: the
    result gets a ``level`` number, and the keys outside a level are NULL.
    """
    keys = list(keys or [])
    names = names or [f"q{p:g}" for p in probs]
    groupings = [keys] if levels is None else levels
    # two scans of these columns alone: one counts cells, one looks into the wanted ones
    base = written(df.select(*keys, finite(F.col(value).cast("double")).alias("_v")), "quantiles")
    out = _by_counting(base, keys, list(enumerate(groupings)), probs, names)
    if levels is not None:
        return out
    if keys:
        return out.drop("level")
    # a table without rows has one group too
    counts = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("n_rows", "n_values")]
    return out.agg(*counts, *[F.max(f"`{n}`").alias(n) for n in names])


def _by_counting(
    base: DataFrame, given: list[str], levels: list[tuple[int, list[str]]], probs: list[float], names: list[str]
) -> DataFrame:
    """Order statistics from cumulative cell counts, for groups of any size.

    Coarser groupings are counted from the finest counts, not from the rows.
    """
    keys = ["level", *given]
    base = base.withColumn("_b", _coarse_cell(F.col("_v")))
    counts = base.groupBy(*given, "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    counts = _per_level(counts, given, levels).groupBy(*keys, "_b").agg(
        F.sum("_c").alias("_c"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    base = _per_level(base, given, levels)

    group = Window.partitionBy(*keys)
    before = group.orderBy(F.col("_b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = F.when(F.col("_b").isNotNull(), F.col("_c")).otherwise(F.lit(0))
    coarse = (
        counts.withColumn("_n_rows", F.sum("_c").over(group))
        .withColumn("_n", F.sum(ranked).over(group))
        .withColumn("_base", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    )
    empty = (F.col("_n") == 0) & F.col("_b").isNull()
    wanted = F.col("_b").isNotNull() & _holds_wanted_rank(probs)
    cells = durable(coarse.filter(empty | wanted))
    no_values = cells.filter(F.col("_b").isNull())
    cells = cells.filter(F.col("_b").isNotNull())

    def rows_in(cells: DataFrame, n_cells: int, columns: list[str]) -> DataFrame:
        side = cells.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_k_b"), "_lo", "_hi", "_base", "_n", "_n_rows"
        )
        if n_cells <= BROADCAST_MAX_ROWS:
            side = F.broadcast(side)
        on = (F.col("_b") == F.col("_k_b")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return base.join(side, on).select(*keys, "_v", "_b", *columns)

    while True:
        size = cells.agg(F.count(F.lit(1)).alias("cells"), F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_c"))).alias("rows")).first()
        if (size["rows"] or 0) <= CELL_MAX_ROWS:
            break
        width = F.col("_hi") - F.col("_lo")
        part = F.when(width > 0, F.floor((F.col("_v") - F.col("_lo")) / width * _SPLIT)).otherwise(F.lit(0)).cast("long")
        split_by = [*keys, "_b", "_from"]
        inside = Window.partitionBy(*split_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        finer = (
            rows_in(cells, size["cells"], ["_lo", "_hi", "_base", "_n", "_n_rows"])
            .withColumn("_part", part)
            .withColumnRenamed("_lo", "_from")
            .groupBy(*split_by, "_part", "_base", "_n", "_n_rows")
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            .withColumn("_base", F.col("_base") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
            .drop("_from", "_part")
        )
        cells = durable(finer.filter(_holds_wanted_rank(probs)))

    within = Window.partitionBy(*keys, "_b", "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = (
        rows_in(cells, size["cells"], ["_lo", "_base", "_n", "_n_rows"])
        .groupBy(*keys, "_b", "_lo", "_base", "_n", "_n_rows", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_base", F.col("_base") + F.coalesce(F.sum("_c").over(within), F.lit(0)))
        .filter(_holds_wanted_rank(probs))
        .select(*keys, "_v", "_base", "_c", "_n", "_n_rows")
    )
    found = values.unionByName(
        no_values.select(*keys, F.lit(None).cast("double").alias("_v"), "_base", "_c", "_n", "_n_rows")
    )

    aggregates = []
    for name, (low, high, weight) in zip(names, _wanted_ranks(F.col("_n"), probs)):
        end = F.col("_base") + F.col("_c")
        at_low = F.max(F.when((F.col("_base") <= low) & (low < end), F.col("_v")))
        at_high = F.max(F.when((F.col("_base") <= high) & (high < end), F.col("_v")))
        aggregates.append((at_low + (at_high - at_low) * F.max(weight)).alias(name))
    return found.groupBy(*keys).agg(
        F.coalesce(F.max("_n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.max("_n"), F.lit(0)).alias("n_values"), *aggregates
    )


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Quantiles of several columns in one fit, as numbers (columns x probabilities)."""
    names = [f"q{i}" for i in range(len(probs))]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    rows = exact_quantiles(long, "value", probs, ["column"], names).collect()
    found = {r["column"]: [r[n] for n in names] for r in rows}
    return {c: found.get(c, [None] * len(probs)) for c in columns}
