"""Reading sales files and prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file with a header. Give the schema for large files: inferring it reads them twice."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", False)
    reader = reader.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").option("nanValue", "NaN")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read ``path`` as CSV when it says so, else as parquet."""
    if path.rstrip("/").endswith(".csv"):
        return scan_csv(spark, path, schema)
    return scan_parquet(spark, path)


def scan_predictions(
    spark: SparkSession, path: str, actual: str = "price", prediction: str = "pred_model", schema: T.StructType | str | None = None
) -> DataFrame:
    """A written prediction table; the actual and predicted columns must be there."""
    df = scan(spark, path, schema)
    missing = sorted({actual, prediction} - set(df.columns))
    if missing:
        raise ValueError(f"{path} must contain {sorted([actual, prediction])}; missing: {missing}")
    return df
