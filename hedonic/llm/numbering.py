"""Gapless numbers within classes of rows, without bringing a class together.

Every task numbers its own rows per class. Those rows are written once; the counts
per task and class are summed to offsets, one row per task and class, and added.
A class that holds most rows therefore never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.common import within
from hedonic.session import written


def counted(df: DataFrame, by: str, name: str) -> DataFrame:
    """``df`` written with the task (``_part``) and the number in task and class (``_nth``).

    ``by`` is an integer column without NULLs.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            codes = batch.column(by).to_numpy(zero_copy_only=False)
            kinds, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
            before = np.array([seen.get(k, 0) for k in kinds.tolist()], dtype=np.int64)
            nth = within(which) + before[which]
            seen.update(zip(kinds.tolist(), (before + counts).tolist()))
            extra = [pa.array(np.full(len(codes), part, dtype=np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "_part", "_nth"])

    return written(df.mapInArrow(number, schema), name)


def numbered(df: DataFrame, by: str, out: str, name: str) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... within each value of the integer column ``by``."""
    rows = counted(df, by, name)
    sizes = rows.groupBy(F.col("_part").alias("_p"), F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_by").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", "_by", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    same = (rows["_part"] == offsets["_p"]) & (rows[by] == offsets["_by"])
    return rows.join(offsets, same).withColumn(out, F.col("_offset") + F.col("_nth")).drop("_p", "_by", "_offset", "_part", "_nth")
