"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard draws a number from the record key and its own number; the shard with the
highest weighted score takes the record. A score depends on nothing but key and shard,
so a further shard takes records only into itself and all others stay where they are.
The scores are plain column expressions; nothing is shuffled to find a shard.

Defined cases: records with equal keys go to the same shard; NULL keys hash like any
value and share a shard per remaining key columns; a NULL text has size 1 and checksum 0;
an empty table gives no rows. Other columns of the input are left out unless asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import table
from hedonic.llm.numbering import numbered

SHARDS = 16


def score(keys: Sequence[Column], shard: int, weight: float) -> Column:
    """The weighted score of one shard for a record key: weight / -ln(u), u drawn from key and shard."""
    # 52 bits and a half more fit a double, so u is never 1 and its logarithm never 0
    draw = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard).cast("long")), 12)
    u = (draw.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.lit(float(weight)) / -F.log(u)


def shard_of(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The number of the shard that takes a record; shards of weight 0 take none, ties go to the smaller number."""
    open_shards = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not open_shards or min(weights) < 0:
        raise ValueError("weights must not be negative and at least one must be positive")
    scored = [F.struct(score(keys, i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in open_shards]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["shard"]).cast("int")


def assign(df: DataFrame, keys: Sequence[str], weights: Sequence[float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; no shuffle and no Python."""
    return df.withColumn(out, shard_of([F.col(k) for k in keys], weights))


def slots(df: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """``df`` with a gapless number within each shard, counted per task so that no shard meets in one task."""
    return numbered(df, shard, out, "shards")


def write_shards(df: DataFrame, keys: Sequence[str], weights: Sequence[float], path: str) -> None:
    """Write every row into the folder of its shard (``path``/shard=K), straight from the tasks that read it."""
    assign(df, keys, weights).write.partitionBy("shard").parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    even = [1.0] * SHARDS
    placed = assign(assign(docs, ["doc_id"], even), ["doc_id"], [*even, 1.0], "grown_shard")
    return slots(placed).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
