"""Exact global ranks and equal-frequency bins without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def rank_first(df: DataFrame, order: list[Column | str], rank: str = "rank", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in the global order.

    ``order`` must end in a unique key: it plays the part of the row order that
    breaks ties. The rows are range-partitioned and sorted once and then kept, so
    that each row's place within its partition stays fixed; the partition offsets
    (one row per partition) are joined back.
    """
    placed = durable(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # one row per sorted partition, whatever the number of data rows
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, (F.col("_offset") + in_part + 1).cast("long"))
    )
    if total:
        out = out.withColumn(total, F.col("_total").cast("long"))
    return out.drop("_place", "_part", "_offset", "_total")


def bin_of_rank(rank: Column, n: Column, q: int) -> Column:
    """The 0-based equal-frequency bin of a rank: edges at 1 + (n-1)*i/q, right-closed.

    Whole-number arithmetic, so no row changes sides through rounding.
    """
    span = F.greatest(n - 1, F.lit(1))
    shifted = (rank - 1) * F.lit(q) + span - 1
    edge = F.floor((shifted - F.pmod(shifted, span)) / span)
    return F.when(n <= 1, F.lit(0)).otherwise(F.greatest(edge - 1, F.lit(0))).cast("int")


def qcut(df: DataFrame, value: str, key: str, q: int, bin_col: str = "bin") -> DataFrame:
    """Add the equal-frequency bin of ``value``, ties broken by ``key``; NULL values are dropped."""
    ranked = rank_first(df.filter(F.col(value).isNotNull()), [F.col(value), F.col(key)], "_rank", "_n")
    return ranked.withColumn(bin_col, bin_of_rank(F.col("_rank"), F.col("_n"), q)).drop("_rank", "_n")
