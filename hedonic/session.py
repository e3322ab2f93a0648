"""Session defaults, durable intermediate results and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only after its rows and bytes were counted and found to be
# at most these: long texts make few rows large, and short ones make many rows cheap.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 << 20


def build_session(app_name: str = "hedonic", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partitions, driver memory and the checkpoint folder are left to the
    cluster unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoints go with the frames that they belong to
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for durable intermediate results.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = sc.getCheckpointDir()
    if configured:
        if not active:
            sc.setCheckpointDir(configured)
        return configured
    if active:
        return active
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="hedonic-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written table."""
    return f"{shared_dir(spark).rstrip('/')}/hedonic/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once and keep the rows in the shared checkpoint folder.

    Later plans read those files, so they neither repeat the work nor depend on
    the executors that did it.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Tables written inside the innermost scope of ``scratch``; none outside of one.
_scopes: list[list[str]] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Whatever ``written`` writes inside is deleted at the end, also after an error.

    For work whose results are stored elsewhere: its frames can't be read afterwards.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Evaluate ``df`` once into a parquet table in the shared folder.

    For large intermediate tables that several passes read: these scan only the
    columns they use, and push their filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """About how many bytes a row takes: eight per value, and the length of texts."""
    sizes = F.lit(0).cast("long")
    for f in df.schema.fields:
        if columns is None or f.name in columns:
            text = isinstance(f.dataType, (T.StringType, T.BinaryType))
            sizes = sizes + F.lit(8) + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if text else F.lit(0))
    return sizes


class Lookup:
    """A fitted table together with the rows and bytes that decide how it is joined."""

    def __init__(self, table: DataFrame, rows: int | None = None, size: int | None = None):
        """Keep and measure ``table``; with ``rows`` it is taken as kept already, with ``size`` as measured."""
        self.table = durable(table) if rows is None else table
        if rows is None or size is None:
            counted = self.table.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(self.table)).alias("size")).first()
            rows, size = counted["rows"], counted["size"] or 0
        self.rows, self.size = rows, size

    @property
    def side(self) -> DataFrame:
        """The table, marked for broadcast when it is known to be small.

        Above the limits it stays a shuffled join side: AQE splits the partitions
        of a hot key on the row side and repeats the lookup rows for them.
        """
        small = self.rows <= BROADCAST_MAX_ROWS and self.size <= BROADCAST_MAX_BYTES
        return F.broadcast(self.table) if small else self.table


def join_lookup(df: DataFrame, lookup: Lookup, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``lookup`` to ``df`` on equal keys, where NULL matches NULL."""
    side = lookup.side
    for key in keys:
        side = side.withColumnRenamed(key, f"_lk_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & df[key].eqNullSafe(side[f"_lk_{key}"])
    joined = df.join(side, condition, how)
    return joined.drop(*[f"_lk_{key}" for key in keys])
