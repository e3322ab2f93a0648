"""Regressor families by name, their parameters, and one fitted model with its smear factor."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.regression import (
    GBTRegressionModel,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.models import boosting, forest
from hedonic.models.boosting import BoostParams
from hedonic.models.encode import FeatureEncoder
from hedonic.operators.target import log_target, smear_factor, to_dollars

FAMILY = {"ridge": "ridge", "random_forest": "rf", "rf": "rf", "xgboost": "boosted", "xgb": "boosted", "boosted": "boosted"}

# The usual parameter names and what the distributed estimators call them.
FOREST_PARAMS = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "min_impurity_decrease": "minInfoGain",
    "max_features": "featureSubsetStrategy",
    "max_samples": "subsamplingRate",
    "bootstrap": "bootstrap",
    "random_state": "seed",
}
RIDGE_PARAMS = {"alpha", "fit_intercept", "solver", "max_iter", "tol"}
# Set by machines or libraries, without meaning for a distributed fit.
IGNORED = {"n_jobs", "copy_X", "random_state", "verbosity", "verbose", "tree_method", "device", "predictor", "objective", "enabled"}
MAX_TREE_DEPTH = 30  # the deepest tree that the forest's trainer grows
# How ridge is solved: "normal" takes up to 4,096 vector positions (the trainer's own
# limit, an error beyond it), "l-bfgs" any number, in at most ``max_iter`` steps.
SOLVERS = ("normal", "l-bfgs")


def resolve_kind(kind: str, settings: Mapping[str, Any] | None = None) -> str:
    """The family of a model name; ``auto`` prefers boosted trees unless they are disabled."""
    name = kind.lower().strip()
    if name == "auto":
        boosted = (settings or {}).get("model", {}).get("xgboost", {})
        return "rf" if boosted.get("enabled", True) is False else "boosted"
    if name not in FAMILY:
        raise ValueError(f"Unknown model kind: {kind!r}. Choose auto, xgboost, random_forest or ridge.")
    return FAMILY[name]


_NAMES = {"ridge": dict.fromkeys(RIDGE_PARAMS), "rf": FOREST_PARAMS, "boosted": BoostParams.NAMES}


def without_counterpart(family: str, params: Mapping[str, Any]) -> dict[str, Any]:
    """The given parameters that the distributed trainer has nothing for, or cannot follow; they are reported, not lost."""
    out = {k: v for k, v in params.items() if k not in _NAMES[family] and k not in IGNORED}
    if family == "rf" and "max_depth" in params and effective_depth(params["max_depth"]) != params["max_depth"]:
        out["max_depth"] = params["max_depth"]
    return out


def effective_depth(depth: int | None) -> int:
    """The depth that trees are grown to; no limit and very deep ones mean the deepest possible."""
    return MAX_TREE_DEPTH if depth is None else min(int(depth), MAX_TREE_DEPTH)


def distinct_candidates(family: str, candidates: Sequence[Mapping[str, Any]]) -> list[dict[str, Any]]:
    """The candidates without those that the trainer would fit in the same way again."""
    seen, out = set(), []
    for params in candidates:
        same = {k: effective_depth(v) if k == "max_depth" and family == "rf" else v for k, v in params.items()}
        told = repr(sorted(same.items()))
        if told not in seen:
            seen.add(told)
            out.append(dict(params))
    return out


def _translated(params: Mapping[str, Any], names: Mapping[str, str]) -> dict[str, Any]:
    out = {names[k]: v for k, v in params.items() if k in names}
    if "maxDepth" in out:
        out["maxDepth"] = effective_depth(out["maxDepth"])
    if "featureSubsetStrategy" in out:
        share = out["featureSubsetStrategy"]
        # a whole number is a number of features, a fraction their share: 1 is one feature, 1.0 all
        everything = share is None or (isinstance(share, float) and share == 1.0)
        out["featureSubsetStrategy"] = "all" if everything else str(share)
    return out


def make_estimator(family: str, params: Mapping[str, Any], rows: int = 1, label_std: float = 1.0):
    """The untrained regressor on ``features`` and ``label``.

    Ridge divides its penalty by the rows and scales it with the label's deviation,
    which the trainer multiplies out again: the result minimises |y - Xw|^2 + alpha |w|^2.
    """
    common = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    if family == "ridge":
        solver = params.get("solver", "normal")
        if solver not in SOLVERS:
            raise ValueError(f"Unknown ridge solver: {solver!r}. Choose normal or l-bfgs.")
        return LinearRegression(
            regParam=float(params.get("alpha", 1.0)) / max(rows, 1) * label_std,
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=bool(params.get("fit_intercept", True)),
            solver=solver,
            maxIter=int(params.get("max_iter", 1000)),
            tol=float(params.get("tol", 1e-10)),
            **common,
        )
    if family == "rf":
        return RandomForestRegressor(**{"featureSubsetStrategy": "all", **_translated(params, FOREST_PARAMS)}, **common)
    raise ValueError(f"{family} is not fitted by an estimator, but by the trainer in boosting.py")


_MODEL_CLASSES = {"ridge": LinearRegressionModel, "rf": RandomForestRegressionModel, "boosted": GBTRegressionModel}


@dataclass
class PriceModel:
    """A fitted encoder and regressor with the way back to dollars."""

    family: str
    params: dict[str, Any]
    encoder: FeatureEncoder
    regressor: Any
    smear: float | None
    log: bool = True
    target: str = "price"

    def predict(self, df: DataFrame, column: str = "pred_model", encoded: bool = False) -> DataFrame:
        """Add the predicted price in dollars."""
        vectors = df if encoded else self.encoder.transform(df)
        out = self.regressor.transform(vectors)
        keep = [c for c in df.columns if c != "features"]
        return out.select(*keep, to_dollars(F.col("prediction"), self.smear, self.log).alias(column))

    def params_table(self, spark: SparkSession) -> DataFrame:
        """All parameters of the regressor as text, one row each; unset ones are NULL.

        Given parameters that the trainer has no counterpart for follow as not applied.
        """
        rows = [(self.family, f"not applied: {k}", str(v)) for k, v in sorted(without_counterpart(self.family, self.params).items())]
        if self.family == "boosted":
            rows += [(self.family, k, str(v)) for k, v in sorted(self.params.items()) if k in BoostParams.NAMES]
        for param in sorted(self.regressor.params, key=lambda p: p.name):
            value = self.regressor.getOrDefault(param) if self.regressor.isDefined(param) else None
            rows.append((self.family, param.name, None if value is None or value != value else str(value)))
        return spark.createDataFrame(rows, "family string, param string, value string")

    def importances(self, spark: SparkSession) -> DataFrame | None:
        """Tree importances summed over the vector positions of each source column."""
        if not hasattr(self.regressor, "featureImportances"):
            return None
        weights = self.regressor.featureImportances.toArray()
        rows = [(group, float(w)) for group, w in zip(self.encoder.slots, weights)]
        slots = spark.createDataFrame(rows, "`group` string, importance double")
        return slots.groupBy("group").agg(F.sum("importance").alias("importance")).orderBy(F.desc("importance"), "group")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.encoder.save(f"{path}/encoder")
        self.regressor.write().overwrite().save(f"{path}/regressor")
        row = [(self.family, self.target, self.log, None if self.smear is None else float(self.smear))]
        spark.createDataFrame(row, "family string, target string, log boolean, smear double").write.mode("overwrite").parquet(f"{path}/target")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PriceModel:
        row = spark.read.parquet(f"{path}/target").first()
        regressor = _MODEL_CLASSES[row["family"]].load(f"{path}/regressor")
        return cls(row["family"], {}, FeatureEncoder.load(spark, f"{path}/encoder"), regressor, row["smear"], row["log"], row["target"])


def fit_encoded(
    family: str,
    params: Mapping[str, Any],
    vectors: DataFrame,
    encoder: FeatureEncoder,
    target: str = "price",
    log: bool = True,
    smearing: bool = True,
    blocks: tuple[boosting.Layout, DataFrame] | None = None,
) -> PriceModel:
    """Fit a regressor on encoded training rows and its smear factor on their residuals.

    Boosted trees are always fitted on blocks, a forest where they are given.
    """
    if family == "boosted":
        return fit_boosted_stages([params], vectors, encoder, target, log, smearing, blocks).models()[0]
    if family == "rf" and blocks is not None:
        regressor, smear = forest.fit(vectors.sparkSession, make_estimator(family, params), *blocks, log and smearing)
        return PriceModel(family, dict(params), encoder, regressor, smear, log, target)
    labelled = log_target(vectors, target, "label", log).select("features", "label")
    rows, std = 1, 1.0
    if family == "ridge":
        # the two solvers scale the penalty by different deviations
        spread = F.stddev_pop("label") if params.get("solver", "normal") == "normal" else F.stddev_samp("label")
        stats = labelled.agg(F.count(F.lit(1)).alias("rows"), spread.alias("std")).first()
        rows, std = stats["rows"], stats["std"] or 1.0
    estimator = make_estimator(family, params, rows, std)
    regressor = estimator.fit(labelled)
    if family == "ridge" and estimator.getSolver() == "l-bfgs" and regressor.summary.totalIterations >= estimator.getMaxIter():
        raise RuntimeError(f"ridge did not converge in {estimator.getMaxIter()} iterations; raise max_iter or tol")
    smear = smear_factor(regressor.transform(labelled), log=log, smearing=smearing)
    return PriceModel(family, dict(params), encoder, regressor, smear, log, target)


class _Whole:
    """A model of the first trees of a fit, built when something of it is asked for."""

    def __init__(self, build: Callable[[], GBTRegressionModel]):
        self._build, self._model = build, None

    def __getattr__(self, name: str) -> Any:
        if self._model is None:
            self._model = self._build()
        return getattr(self._model, name)


@dataclass
class BoostedStages:
    """One boosted fit that stands for several candidates, which differ in the number of trees only."""

    params: list[dict[str, Any]]
    ends: list[int]  # of the parts, in trees
    parts: list[GBTRegressionModel]
    whole: Callable[[int], GBTRegressionModel]
    encoder: FeatureEncoder
    smears: list[float | None]
    log: bool
    target: str

    def predicted(self, vectors: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``vectors`` with the sums of each part's trees, and for each candidate its prediction in dollars: all in one pass."""
        sums, upto = _summed(vectors, self.parts)
        return sums, [to_dollars(upto[self.ends.index(_rounds(p))], smear, self.log) for p, smear in zip(self.params, self.smears)]

    def models(self) -> list[PriceModel]:
        """A model per candidate."""
        out = []
        for params, smear in zip(self.params, self.smears):
            n = _rounds(params)
            regressor = self.parts[0] if n == self.ends[0] else _Whole(lambda n=n: self.whole(n))
            out.append(PriceModel("boosted", dict(params), self.encoder, regressor, smear, self.log, self.target))
        return out


def _rounds(params: Mapping[str, Any]) -> int:
    return BoostParams.of(params).rounds


def _summed(vectors: DataFrame, parts: Sequence[GBTRegressionModel]) -> tuple[DataFrame, list[Column]]:
    """``vectors`` with the prediction of each part, and the sums of the first one, two, ... of them."""
    sums, total = [], F.lit(0.0)
    for i, part in enumerate(parts):
        name = f"_part_{i}"
        vectors = part.setPredictionCol(name).transform(vectors)
        part.setPredictionCol("prediction")
        total = total + F.col(name)
        sums.append(total)
    return vectors, sums


def boosted_blocks(vectors: DataFrame, encoder: FeatureEncoder, target: str = "price", log: bool = True) -> tuple[boosting.Layout, DataFrame]:
    """The encoded rows as the boosted trainer reads them."""
    labelled = log_target(vectors, target, "label", log).select("features", "label")
    return boosting.binned(labelled, len(encoder.numeric), [encoder.widths[c] for c in encoder.categorical])


def fit_boosted_stages(
    candidates: Sequence[Mapping[str, Any]],
    vectors: DataFrame,
    encoder: FeatureEncoder,
    target: str = "price",
    log: bool = True,
    smearing: bool = True,
    blocks: tuple[boosting.Layout, DataFrame] | None = None,
) -> BoostedStages:
    """Fit candidates that differ in ``n_estimators`` only once, with the most trees; smaller numbers are its beginnings.

    Several fits on the same rows can share their ``blocks``.
    """
    longest = max(candidates, key=_rounds)
    ends, params = sorted({_rounds(c) for c in candidates}), BoostParams.of(longest)
    # the trainer has the residuals that smearing asks for
    made = boosting.fit_stages(vectors.sparkSession, *(blocks or boosted_blocks(vectors, encoder, target, log)), params, ends, log and smearing)
    parts, whole, ratios = made
    smears = [ratios.get(_rounds(c), 1.0) if log and smearing else None for c in candidates]
    return BoostedStages([dict(c) for c in candidates], ends, parts, whole, encoder, smears, log, target)
