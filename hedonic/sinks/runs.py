"""Run outputs as tables: one folder per kind, partitioned by run."""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREDICTION_COLUMNS = ["sold_date", "city", "state", "zip_code", "price"]
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.\-]*")


def new_run_id(name: str | None = None) -> str:
    """The given name, or the current time in a form that sorts by time."""
    run_id = name or datetime.now(timezone.utc).strftime("%Y-%m-%d_%H%M%S")
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id is made of letters, digits, '_', '.' and '-', not {run_id!r}")
    return run_id


class RunStore:
    """Writes and reads the outputs of a run below ``base``.

    Each kind of output is one parquet table with ``run_id`` as its first partition
    column. The schema is written beside it, so that an empty output can be read and
    partition values stay the text that was written. The first write of a kind in a run
    replaces all that this run had of it; later ones replace only their own partitions.
    Rows are written beside the table and moved into place when all are there, so a write
    that fails leaves the earlier output as it was.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None):
        self.spark, self.base, self.run_id = spark, base.rstrip("/"), new_run_id(run_id)
        self._begun: set[str] = set()

    def path(self, kind: str) -> str:
        return f"{self.base}/{kind}"

    def _run_path(self, kind: str, run_id: str) -> str:
        return f"{self.path(kind)}/run_id={run_id}"

    def _schema_path(self, kind: str, run_id: str) -> str:
        return f"{self.base}/schemas/{kind}/{run_id}"

    def write(self, kind: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write one output table and return it as read back, this run only."""
        parts = partition_by or []
        texts = df.drop("run_id").withColumns({c: F.col(c).cast("string") for c in parts})
        writer = texts.write.mode("overwrite").partitionBy(*parts)
        if parts and kind in self._begun:
            # Spark itself stages these partitions until the job has ended
            writer.option("partitionOverwriteMode", "dynamic").parquet(self._run_path(kind, self.run_id))
        else:
            staged = f"{self.base}/_staged/{kind}-{uuid.uuid4().hex}"
            writer.parquet(staged)
            self._publish(staged, self._run_path(kind, self.run_id))
        self._begun.add(kind)
        described = json.dumps({"schema": texts.schema.jsonValue(), "parts": parts})
        self.spark.createDataFrame([(described,)], "value string").coalesce(1).write.mode("overwrite").text(self._schema_path(kind, self.run_id))
        return self.read(kind, self.run_id)

    def _publish(self, staged: str, path: str) -> None:
        """Put a folder that is written completely in the place of another one."""
        source, target = (self.spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
        fs = target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"{staged} could not be moved to {path}")
        self.spark.catalog.refreshByPath(path)

    def runs(self, kind: str) -> list[str]:
        """The runs that wrote this kind, in order: names of folders, no file is opened."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path(kind))
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(n.removeprefix("run_id=") for n in names if n.startswith("run_id="))

    def _read_run(self, kind: str, run_id: str) -> DataFrame:
        text = "".join(r["value"] for r in self.spark.read.text(self._schema_path(kind, run_id)).collect())  # one line
        described = json.loads(text)
        fields = T.StructType.fromJson(described["schema"]).fields
        kept = [f for f in fields if f.name not in described["parts"]]
        schema = T.StructType([*kept, T.StructField("run_id", T.StringType()), *[T.StructField(c, T.StringType()) for c in described["parts"]]])
        return self.spark.read.schema(schema).option("basePath", self.path(kind)).parquet(self._run_path(kind, run_id))

    def read(self, kind: str, run_id: str | None = None) -> DataFrame:
        """One run's rows, or those of all runs; columns that a run did not have are NULL."""
        names = [run_id] if run_id else self.runs(kind)
        if not names:
            raise FileNotFoundError(f"no run has written {kind} below {self.base}")
        out = self._read_run(kind, names[0])
        for name in names[1:]:
            out = out.unionByName(self._read_run(kind, name), allowMissingColumns=True)
        return out

    def latest(self, kind: str) -> DataFrame:
        """The rows of the newest run; the folders' names tell which, other runs are not read."""
        names = self.runs(kind)
        return self.read(kind, names[-1] if names else None)

    # --- the outputs of a run -------------------------------------------------

    def predictions(self, df: DataFrame, split: str, family: str, columns: list[str] | None = None) -> DataFrame:
        """Key columns, actual and predicted prices of one split and model family."""
        kept = [c for c in (columns or PREDICTION_COLUMNS) if c in df.columns]
        kept += [c for c in df.columns if c.startswith("pred_") and c not in kept]
        out = df.select(*kept).withColumns({"split": F.lit(split), "family": F.lit(family)})
        written = self.write("predictions", out, ["split", "family"])
        return written.filter((F.col("split") == split) & (F.col("family") == family))

    def predictions_csv(self, df: DataFrame, name: str, columns: list[str] | None = None) -> str:
        """The same as a CSV folder for other tools; returns its path."""
        kept = [c for c in (columns or PREDICTION_COLUMNS) if c in df.columns]
        kept += [c for c in df.columns if c.startswith("pred_") and c not in kept]
        path = f"{self.base}/run/{self.run_id}/preds/{name}.csv"
        df.select(*kept).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return path

    def metrics(self, summary: DataFrame) -> DataFrame:
        """Wide metric rows (family, split, MAE, RMSE, R2) as a long table."""
        values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("MAE", "RMSE", "R2")])
        return self.write("metrics", summary.select("family", "split", F.inline(values)))

    def summary(self, df: DataFrame) -> DataFrame:
        return self.write("summary", df)

    def slices(self, df: DataFrame, kind: str = "slices") -> DataFrame:
        return self.write(kind, df)

    def calibration(self, bins: DataFrame) -> DataFrame:
        return self.write("calibration", bins)

    def importances(self, df: DataFrame, family: str) -> DataFrame:
        return self.write("importances", df.withColumn("family", F.lit(family)), ["family"])

    def overview(self, df: DataFrame) -> DataFrame:
        return self.write("overview", df)

    def params(self, df: DataFrame) -> DataFrame:
        return self.write("params", df)

    def model_path(self, family: str) -> str:
        return f"{self.base}/models/run_id={self.run_id}/{family}"
