"""Fitted feature preparation: filling, scaling, rare categories, one-hot vectors.

Everything is learned from training rows. Numbers become literals in the plan; the
category table stays a joined table; the vector stages are ordinary ML stages.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.operators.quantiles import column_quantiles
from hedonic.operators.ranking import rank_first
from hedonic.session import Lookup, durable, row_bytes, written

# A forest's trainer keeps a number for each vector position of each row. Up to so many of them
# the rows stay as they come; more are spread out, so that a task has about so many.
TOTAL_NUMBERS, TASK_NUMBERS = 1 << 28, 1 << 24
# Beyond so many a forest is fitted on blocks of codes (forest.py) and the rows stay where they are.
DENSE_NUMBERS = 1 << 29
# The bucket of training categories that are too rare for a column of their own.
INFREQUENT = "__infrequent__"


def numeric_fills(train: DataFrame, columns: list[str], strategy: str = "median", constant: float = 0.0) -> dict[str, float]:
    """The value for missing entries of each column: exact median, mean or a constant."""
    if strategy == "constant":
        return {c: float(constant) for c in columns}
    if strategy == "mean":
        row = train.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    return {c: q[0] for c, q in column_quantiles(train, columns, [0.5]).items()}


def category_counts(train: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value of each column occurs in training: column, value, count."""
    long = train.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return long.groupBy("column", "value").count()


def categorical_fills(counts: DataFrame, columns: list[str], strategy: str = "most_frequent", constant: str = "missing") -> dict[str, str]:
    """The most frequent value of each column (the smallest among equals), or a constant."""
    if strategy == "constant":
        return {c: constant for c in columns}
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    top = counts.filter(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == 1)
    return {r["column"]: r["value"] for r in top.collect()}  # one row per column


def category_buckets(counts: DataFrame, fills: Mapping[str, str], min_frequency: int | float | None) -> DataFrame:
    """Each training category with its bucket: itself, or INFREQUENT when it is too rare.

    ``min_frequency`` is a number of rows, or a share of all rows when below one.
    """
    fill = reduce(lambda acc, item: acc.when(F.col("column") == item[0], F.lit(item[1])), fills.items(), F.when(F.lit(False), F.lit(None)))
    filled = counts.withColumn("value", F.coalesce(F.col("value"), fill)).groupBy("column", "value").agg(F.sum("count").alias("count"))
    if min_frequency is None:
        return filled.withColumn("bucket", F.col("value"))
    if isinstance(min_frequency, float):
        # the total is the same for each column; a window over one row per category
        per_column = filled.groupBy("column").agg(F.sum("count").alias("_rows"))
        filled = filled.join(F.broadcast(per_column), "column")  # one row per column
        rare = F.col("count") < F.lit(min_frequency) * F.col("_rows")
    else:
        rare = F.col("count") < min_frequency
    return filled.withColumn("bucket", F.when(rare, F.lit(INFREQUENT)).otherwise(F.col("value"))).select("column", "value", "count", "bucket")


def scale_moments(filled: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column is only centred."""
    stats = [s for c in columns for s in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = filled.agg(*stats).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


@dataclass
class FeatureEncoder:
    numeric: list[str]
    categorical: list[str]
    numeric_fill: dict[str, float]
    scale: dict[str, tuple[float, float]]
    categorical_fill: dict[str, str]
    buckets: dict[str, Lookup]
    vectors: PipelineModel | None = None
    widths: dict[str, int] = field(default_factory=dict)

    def fill(self, df: DataFrame) -> DataFrame:
        """Missing numbers filled and, where fitted, scaled; missing categories filled."""
        out = {}
        for c in self.numeric:
            v = F.coalesce(F.col(c).cast("double"), F.lit(self.numeric_fill[c]))
            out[f"num_{c}"] = (v - self.scale[c][0]) / self.scale[c][1] if c in self.scale else v
        for c in self.categorical:
            out[f"cat_{c}"] = F.coalesce(F.col(c).cast("string"), F.lit(self.categorical_fill[c]))
        return df.withColumns(out) if out else df

    def bucket(self, df: DataFrame) -> DataFrame:
        """Categories as their training bucket; a category unknown to training becomes NULL."""
        return self._looked_up(df, "bucket", "bkt")

    def _looked_up(self, df: DataFrame, column: str, prefix: str) -> DataFrame:
        for c in self.categorical:
            side = self.buckets[c].side.select(F.col("value").alias("_value"), F.col(column).alias(f"{prefix}_{c}"))
            df = df.join(side, F.col(f"cat_{c}") == F.col("_value"), "left").drop("_value")
        return df

    def numbered(self, df: DataFrame) -> DataFrame:
        """Categories as the slot of their bucket; one unknown to training gets the slot that one-hot drops."""
        out = self._looked_up(df, "slot", "slot")
        numbers = {f"idx_{c}": F.coalesce(F.col(f"slot_{c}"), F.lit(self.widths[c])).cast("double") for c in self.categorical}
        return out.withColumns(numbers) if numbers else out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``features`` vector and leave out the columns made on the way."""
        out = self.vectors.transform(self.numbered(self.fill(df)))
        return out.select(*df.columns, "features")

    def spread(self, df: DataFrame) -> DataFrame:
        """The rows in enough partitions for a trainer that keeps them dense: few narrow rows of a file make large tasks."""
        numbers = self.numbers(df)
        return df if not TOTAL_NUMBERS < numbers <= DENSE_NUMBERS else df.repartition(-(-numbers // TASK_NUMBERS))

    def numbers(self, df: DataFrame) -> int:
        """Vector positions of all rows."""
        return df.count() * len(self.slots)

    def dense(self, df: DataFrame) -> bool:
        """Whether a trainer that keeps the rows dense can take them."""
        return self.numbers(df) <= DENSE_NUMBERS

    @property
    def slots(self) -> list[str]:
        """The source column of each vector position."""
        return [*self.numeric, *[c for c in self.categorical for _ in range(self.widths[c])]]

    def slot_table(self, column: str) -> DataFrame:
        """The one-hot slots of a column: slot, bucket."""
        return self.buckets[column].table.select("slot", "bucket").distinct()

    def save(self, path: str) -> None:
        """Everything below one folder, as ML stages and small tables."""
        spark = SparkSession.active()
        self.vectors.write().overwrite().save(f"{path}/vectors")
        rows = [("num", c, float(self.numeric_fill[c]), *map(float, self.scale.get(c, (0.0, 1.0))), None, c in self.scale) for c in self.numeric]
        rows += [("cat", c, float(self.widths[c]), None, None, self.categorical_fill[c], False) for c in self.categorical]
        schema = "kind string, name string, fill double, mean double, std double, text_fill string, scaled boolean"
        numbered = [(i, *r) for i, r in enumerate(rows)]
        spark.createDataFrame(numbered, "i int, " + schema).write.mode("overwrite").parquet(f"{path}/columns")
        for c in self.categorical:
            self.buckets[c].table.write.mode("overwrite").parquet(f"{path}/buckets/{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureEncoder:
        rows = spark.read.parquet(f"{path}/columns").orderBy("i").collect()
        numeric = [r["name"] for r in rows if r["kind"] == "num"]
        categorical = [r["name"] for r in rows if r["kind"] == "cat"]
        vectors = PipelineModel.load(f"{path}/vectors")
        return cls(
            numeric,
            categorical,
            {r["name"]: r["fill"] for r in rows if r["kind"] == "num"},
            {r["name"]: (r["mean"], r["std"]) for r in rows if r["scaled"]},
            {r["name"]: r["text_fill"] for r in rows if r["kind"] == "cat"},
            {c: Lookup(spark.read.parquet(f"{path}/buckets/{c}")) for c in categorical},
            vectors,
            {r["name"]: int(r["fill"]) for r in rows if r["kind"] == "cat"},
        )


def fit_encoder(train: DataFrame, numeric: list[str], categorical: list[str], settings: Mapping[str, Any] | None = None) -> FeatureEncoder:
    """Learn all of the preparation from training rows.

    ``settings`` is the ``preprocess`` section: numeric_imputer, numeric_fill_value,
    categorical_imputer, categorical_fill_value, one_hot.min_frequency, scaler.
    """
    p = (settings or {}).get("preprocess", {})
    strategy = p.get("numeric_imputer", "median")
    strategy = strategy if strategy in ("median", "mean", "constant") else "median"
    fills = numeric_fills(train, numeric, strategy, p.get("numeric_fill_value", 0.0)) if numeric else {}
    cat_fills, buckets, widths = {}, {}, {}
    if categorical:
        counts = durable(category_counts(train, categorical))
        kind = p.get("categorical_imputer", "most_frequent")
        kind = kind if kind in ("most_frequent", "constant") else "most_frequent"
        cat_fills = categorical_fills(counts, categorical, kind, p.get("categorical_fill_value", "missing"))
        table = durable(category_buckets(counts, cat_fills, p.get("one_hot", {}).get("min_frequency", 50)))
        # written once: the buckets in order, so that a bucket's place in its column is its slot
        placed = rank_first(table.select("column", "bucket").distinct(), ["column", "bucket"], "place")
        first = placed.groupBy("column").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("width"))
        spans = first.collect()  # one row per column
        widths = {r["column"]: r["width"] for r in spans}
        slots = placed.join(F.broadcast(first), "column").select("column", "bucket", (F.col("place") - F.col("first")).cast("int").alias("slot"))
        table = written(table.join(slots, ["column", "bucket"]).select("column", "value", "bucket", "slot"), "categories")
        measured = table.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(table)).alias("size")).collect()
        sizes = {r["column"]: (r["rows"], r["size"]) for r in measured}
        for c in categorical:
            own = table.filter(F.col("column") == c).select("value", "bucket", "slot")
            buckets[c] = Lookup(own, *sizes.get(c, (0, 0)))
        widths = {c: widths.get(c, 0) for c in categorical}
    encoder = FeatureEncoder(list(numeric), list(categorical), fills, {}, cat_fills, buckets, widths=widths)
    if (p.get("scaler") or "").strip().lower() == "standard" and numeric:
        filled = encoder.fill(train.select(*numeric, *categorical))
        moments = scale_moments(filled, [f"num_{c}" for c in numeric])
        encoder.scale = {c: moments[f"num_{c}"] for c in numeric}
    encoder.vectors = _vector_stages(encoder, train.sparkSession)
    return encoder


def _vector_stages(encoder: FeatureEncoder, spark: SparkSession) -> PipelineModel:
    """One-hot and assemble; one row with the slot beyond the last tells one-hot how many there are."""
    numeric = [f"num_{c}" for c in encoder.numeric]
    stages: list[Any] = []
    if encoder.categorical:
        indexed, hot = [f"idx_{c}" for c in encoder.categorical], [f"hot_{c}" for c in encoder.categorical]
        widest = spark.range(1).select(*[F.lit(float(encoder.widths[c])).alias(i) for c, i in zip(encoder.categorical, indexed)])
        stages = [OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="error").fit(widest)]
        numeric = numeric + hot
    return PipelineModel([*stages, VectorAssembler(inputCols=numeric, outputCol="features")])
