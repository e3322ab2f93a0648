"""Parameter sweeps scored on a later year, selection, refits, and whole training runs."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import wraps
from itertools import product
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.models.encode import FeatureEncoder, fit_encoder
from hedonic.models.estimators import PriceModel, boosted_blocks, distinct_candidates, fit_boosted_stages, fit_encoded, resolve_kind
from hedonic.operators import calibration, metrics
from hedonic.operators.features import STANDARD_EXPRESSIONS, add_expressions, time_features, usable_columns
from hedonic.operators.groupstats import fit_baseline, neighbors_from_settings, predict_baseline
from hedonic.operators.profile import date_window, na_summary
from hedonic.operators.split import by_cutoff, by_hash, by_year, downsample_train, part, require_splits
from hedonic.session import scratch, written
from hedonic.sinks.runs import PREDICTION_COLUMNS, RunStore

# The full grids, and the reduced ones of a fast sweep (which leaves the forest out).
GRIDS = {
    "ridge": {"alpha": [0.5, 1.0, 2.0, 5.0]},
    "rf": {"n_estimators": [400, 800], "min_samples_leaf": [1, 2, 4], "max_depth": [None, 20, 40]},
    "boosted": {
        "learning_rate": [0.04, 0.05, 0.06],
        "max_depth": [6, 8, 10],
        "n_estimators": [600, 900, 1200],
        "subsample": [0.8],
        "colsample_bytree": [0.8],
    },
}
FAST_GRIDS = {
    "ridge": {"alpha": [1.0, 2.0]},
    "boosted": {"learning_rate": [0.05], "max_depth": [6], "n_estimators": [400], "subsample": [0.8], "colsample_bytree": [0.8]},
}
# The candidates of the run that selects by RMSE.
CANDIDATES = [
    {"n_estimators": 600, "max_depth": 6, "learning_rate": 0.06, "subsample": 0.8, "colsample_bytree": 0.8},
    {"n_estimators": 900, "max_depth": 8, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8},
    {"n_estimators": 1200, "max_depth": 8, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8},
    {"n_estimators": 1200, "max_depth": 10, "learning_rate": 0.04, "subsample": 0.8, "colsample_bytree": 0.8},
]
NUMERIC = [
    "bed", "bath", "acre_lot", "house_size", "year", "month", "season", "years_since_prev_sale", "property_age",
    "bed_per_bath", "lot_per_size", "log_house_size",
]
CATEGORICAL = ["city", "state", "zip_code"]
TRIAL_SCHEMA = "trial_no int, family string, params string, MAE double, RMSE double, R2 double, smear double"


# Sections of the settings by family.
_SWEEP_SECTION = {"ridge": "ridge", "rf": "rf", "boosted": "xgb"}


def sweep_candidates(settings: Mapping[str, Any]) -> dict[str, list[dict[str, Any]]]:
    """The candidates of each family: the grids of the ``sweep`` section, defaults where it names none.

    ``sweep.xgb.enabled`` and ``model.xgboost.enabled`` switch the boosted family off.
    """
    given = settings.get("sweep", {})
    grids = FAST_GRIDS if settings.get("run", {}).get("fast_sweep", False) else GRIDS
    out = {}
    for family, grid in grids.items():
        section = dict(given.get(_SWEEP_SECTION[family], {}))
        enabled = section.pop("enabled", True)
        if family == "boosted":
            enabled = enabled and settings.get("model", {}).get("xgboost", {}).get("enabled", True)
        if enabled:
            asked = {k: list(v) if isinstance(v, (list, tuple)) else [v] for k, v in section.items()}
            out[family] = distinct_candidates(family, expand_grid({**grid, **asked}))
    return out


def target_of(settings: Mapping[str, Any]) -> tuple[str, bool, bool]:
    """Name of the target, whether it is fitted as a logarithm, and whether the way back is smeared."""
    section = settings.get("target", {})
    return section.get("name", "price"), section.get("log_transform", True), section.get("duan_smearing", True)


def neighbor_mode_of(settings: Mapping[str, Any], mode: str | None) -> str:
    """The given mode, else that of the neighbour section, else ``exact``."""
    return mode or settings.get("features", {}).get("leakage_safe_neighbors", {}).get("mode", "exact")


def _scratched(run: Callable[..., dict[str, DataFrame]]) -> Callable[..., dict[str, DataFrame]]:
    """A run whose tables all come from its store, so that what it wrote on the way can go."""

    @wraps(run)
    def tidy(sales: DataFrame, *args: Any, **options: Any) -> dict[str, DataFrame]:
        with scratch(sales.sparkSession):
            return run(sales, *args, **options)

    return tidy


def expand_grid(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


@dataclass
class Trial:
    number: int
    family: str
    params: dict[str, Any]
    scores: dict[str, float | None]
    model: PriceModel


def score(df: DataFrame, actual: str = "price", prediction: str = "pred_model") -> dict[str, float | None]:
    row = metrics.regression_metrics(df, actual, prediction).first()
    return {m: row[m] for m in ("MAE", "RMSE", "R2")}


def sweep(
    train: DataFrame,
    val: DataFrame,
    encoder: FeatureEncoder,
    candidates: Mapping[str, Sequence[Mapping[str, Any]]],
    target: str = "price",
    log: bool = True,
    smearing: bool = True,
) -> list[Trial]:
    """Fit every candidate on the encoded training rows and score it on the validation rows.

    Both are encoded once and written for all trials. Boosted
    candidates that differ in the number of trees only are one fit, scored in one pass.
    Fits run side by side, as far as the cluster has room for their jobs.
    """
    columns = [target]
    encoded = encoder.transform(train).select(*columns, "features")

    def fit(group: _Group) -> list[tuple[dict[str, float | None], PriceModel]]:
        if group.family == "boosted":
            stages = fit_boosted_stages(group.candidates, train_vectors, encoder, target, log, smearing, blocks)
            predicted, dollars = stages.predicted(val_vectors)
            each = F.inline(F.array(*[F.struct(F.lit(i).alias("stage"), d.alias("pred_model")) for i, d in enumerate(dollars)]))
            found = metrics.regression_metrics(predicted.select(target, each), target, "pred_model", ["stage"]).collect()  # one row per candidate
            by_stage = {r["stage"]: r for r in found}
            return [({m: by_stage[i][m] if i in by_stage else None for m in ("MAE", "RMSE", "R2")}, model) for i, model in enumerate(stages.models())]
        model = fit_encoded(group.family, group.candidates[0], train_vectors, encoder, target, log, smearing)
        return [(score(model.predict(val_vectors, encoded=True), target), model)]

    groups = _groups(candidates)
    with scratch(train.sparkSession):
        val_vectors = written(encoder.transform(val).select(*columns, "features"), "vectors")
        # boosted fits read the blocks alone; rows are binned once for all of them
        train_vectors = written(encoded, "vectors") if any(g.family != "boosted" for g in groups) else encoded
        blocks = boosted_blocks(encoded, encoder, target, log) if any(g.family == "boosted" for g in groups) else None
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            results = list(pool.map(fit, groups))
    trials = [
        Trial(number, group.family, dict(params), scores, model)
        for group, fitted in zip(groups, results)
        for number, params, (scores, model) in zip(group.numbers, group.candidates, fitted)
    ]
    return sorted(trials, key=lambda t: t.number)


# Fits that run at the same time; their jobs share the cluster.
SIDE_BY_SIDE = 4


@dataclass
class _Group:
    """Candidates of one fit, with their numbers."""

    family: str
    numbers: list[int]
    candidates: list[Mapping[str, Any]]


def _groups(candidates: Mapping[str, Sequence[Mapping[str, Any]]]) -> list[_Group]:
    """Candidates in groups of one fit: boosted ones that differ in the number of trees only, others by themselves."""
    out: dict[str, _Group] = {}
    number = 0
    for family, params_list in candidates.items():
        for params in params_list:
            rest = {k: v for k, v in params.items() if k != "n_estimators"} if family == "boosted" else {"number": number}
            group = out.setdefault(json.dumps([family, rest], sort_keys=True, default=str), _Group(family, [], []))
            group.numbers.append(number)
            group.candidates.append(params)
            number += 1
    return list(out.values())


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    rows = [(t.number, t.family, json.dumps(t.params, sort_keys=True), t.scores["MAE"], t.scores["RMSE"], t.scores["R2"], t.model.smear) for t in trials]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_per_family(trials: DataFrame) -> DataFrame:
    """The trial with the highest R2 of each family; the earlier one wins a tie."""
    order = Window.partitionBy("family").orderBy(F.desc_nulls_last("R2"), F.asc("trial_no"))
    return trials.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def best_overall(trials: DataFrame) -> DataFrame:
    """The best of the families' best; the family tried first wins a tie."""
    return best_per_family(trials).orderBy(F.desc_nulls_last("R2"), F.asc("trial_no")).limit(1)


def best_by_rmse(trials: DataFrame) -> DataFrame:
    """Lowest RMSE, going through the trials in order; a nearly equal one wins with the lower MAE."""
    fields = ["trial_no", *[c for c in trials.columns if c != "trial_no"]]
    ordered = F.sort_array(F.collect_list(F.struct(*fields)))  # one element per trial

    def better(best: Column, cur: Column) -> Column:
        near = F.abs(cur["RMSE"] - best["RMSE"]) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(best["RMSE"])
        wins = (cur["RMSE"] < best["RMSE"]) | (near & (cur["MAE"] < best["MAE"]))
        return F.when(wins, cur).otherwise(best)

    listed = trials.agg(ordered.alias("_t"))
    return listed.select(F.aggregate("_t", F.col("_t")[0], better).alias("_b")).select("_b.*")


def refit_all(
    frame: DataFrame,
    chosen: Mapping[str, Mapping[str, Any]],
    numeric: list[str],
    categorical: list[str],
    settings: Mapping[str, Any],
    target: str = "price",
    log: bool = True,
    smearing: bool = True,
) -> dict[str, PriceModel]:
    """A fresh encoder on all given rows, and one model per family on the rows it encoded once."""
    encoder = fit_encoder(frame, numeric, categorical, settings)
    rows = frame.select(*dict.fromkeys([target, *numeric, *categorical]))
    large = "rf" in chosen and not encoder.dense(rows)
    rows = encoder.spread(rows) if "rf" in chosen and not large else rows
    encoded = encoder.transform(rows).select(target, "features")
    with scratch(frame.sparkSession):
        by_blocks = {family for family in chosen if family == "boosted" or family == "rf" and large}
        blocks = boosted_blocks(encoded, encoder, target, log) if by_blocks else None
        if "rf" in chosen and not large:
            # such a forest draws rows by their place, which reading them again would change
            vectors = encoded.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            vectors = written(encoded, "vectors") if set(chosen) - by_blocks else encoded
        try:
            return {family: fit_encoded(family, params, vectors, encoder, target, log, smearing, blocks if family in by_blocks else None) for family, params in chosen.items()}
        finally:
            if vectors is encoded:
                vectors.unpersist()


def refit(frame: DataFrame, family: str, params: Mapping[str, Any], *rest: Any) -> PriceModel:
    """The same for one family."""
    return refit_all(frame, {family: params}, *rest)[family]


def model_frame(sales: DataFrame, settings: Mapping[str, Any] | None = None) -> DataFrame:
    """Clean sales with calendar features and engineered expressions."""
    dated = "sold_date" in sales.columns
    df = time_features(sales) if dated else sales
    return add_expressions(df, (settings or {}).get("features", {}).get("engineered", STANDARD_EXPRESSIONS))


def _feature_lists(settings: Mapping[str, Any]) -> tuple[list[str], list[str]]:
    features = settings.get("features", {})
    return list(features.get("numeric", NUMERIC)), list(features.get("categorical", CATEGORICAL))


def _usable(train: DataFrame, wanted: list[str], *others: DataFrame) -> list[str]:
    try:
        return usable_columns(train, wanted, *others)
    except ValueError:
        return []


def choose_features(train: DataFrame, settings: Mapping[str, Any], added: Sequence[str], *others: DataFrame) -> tuple[list[str], list[str]]:
    """The numeric and categorical columns to use, among the wanted and the added ones."""
    numeric, categorical = _feature_lists(settings)
    numeric = _usable(train, [*numeric, *[c for c in added if c not in numeric]], *others)
    categorical = _usable(train, categorical, *others)
    if not numeric and not categorical:
        raise ValueError("No usable features: check the feature settings.")
    return numeric, categorical


@_scratched
def run_sweep(
    sales: DataFrame,
    settings: Mapping[str, Any],
    store: RunStore,
    key: str,
    candidates: Mapping[str, Sequence[Mapping[str, Any]]] | None = None,
    neighbor_mode: str | None = None,
    symmetric: bool = True,
) -> dict[str, DataFrame]:
    """The whole sweep: split by year, encode once, try all families, refit the best, write the outputs.

    ``settings`` has the sections split, features, preprocess, run, sweep, eval and target;
    ``key`` is the unique row key. Returns the written tables by name. All training rows
    are used unless ``run.max_train_rows`` asks for fewer; ``training_rows`` tells how many
    there were and how many were used.
    """
    spark = sales.sparkSession
    section, run, ev = settings["split"], settings.get("run", {}), settings.get("eval", {})
    target, log, smearing = target_of(settings)
    neighbor_mode = neighbor_mode_of(settings, neighbor_mode)
    if candidates is None:
        candidates = sweep_candidates(settings)

    df = by_year(model_frame(sales, settings), section["train_max_year"], section["val_year"], section["test_min_year"])
    df = require_splits(written(df, "features"), {"train": 1, "val": 1, "test": 1})  # read by every fit below
    train, val, test = part(df, "train"), part(df, "val"), part(df, "test")
    train_val = part(df, "train", "val")

    train_n, val_n, added = neighbors_from_settings(train, val, settings, target, neighbor_mode, symmetric)
    trv_n, test_n, added_test = neighbors_from_settings(train_val, test, settings, target, neighbor_mode, symmetric)
    numeric, categorical = choose_features(train_n, settings, added, val_n)
    numeric_final, categorical_final = choose_features(trv_n, settings, added_test, test_n)

    fit_rows = train_n
    available = train_n.count()
    cap = run.get("max_train_rows")
    if cap:
        fit_rows = part(downsample_train(train_n, int(cap), key, int(run.get("random_state", 0))), "train")
    used = spark.createDataFrame([(available, min(available, int(cap)) if cap else available)], "available bigint, used bigint")
    encoder = fit_encoder(fit_rows, numeric, categorical, settings)
    trials = sweep(fit_rows, val_n, encoder, candidates, target, log, smearing)
    table = trial_table(spark, trials)
    winners = {r["family"]: trials[r["trial_no"]] for r in best_per_family(table).collect()}
    winner = trials[best_overall(table).first()["trial_no"]]

    base_val = predict_baseline(val_n, fit_baseline(train, target))
    base_test = written(predict_baseline(test_n, fit_baseline(train_val, target)), "baseline")
    summary = [("baseline", "median_by_zip_year", "val", score(base_val, target, "pred_baseline"))]
    summary.append(("baseline", "median_by_zip_year", "test", score(base_test, target, "pred_baseline")))
    out: dict[str, DataFrame] = {}
    predictions = None
    chosen = {family: best.params for family, best in winners.items()}
    for family, model in refit_all(trv_n, chosen, numeric_final, categorical_final, settings, target, log, smearing).items():
        best = winners[family]
        predicted = written(model.predict(base_test, "pred_model"), "predictions")
        summary += [(family, family, "val", best.scores), (family, family, "test", score(predicted, target))]
        store.predictions(predicted, "test", family, [key, *PREDICTION_COLUMNS])
        model.save(store.model_path(family))
        importances = model.importances(spark)
        if importances is not None:
            out["importances"] = store.importances(importances, family)
        if family == winner.family:
            predictions = predicted
            model.save(store.model_path("best"))
            out["predictions"] = store.predictions(predicted, "test", "best", [key, *PREDICTION_COLUMNS])
            out["params"] = store.params(model.params_table(spark))

    rows = [(f, n, s, m["MAE"], m["RMSE"], m["R2"]) for f, n, s, m in summary]
    summary_df = spark.createDataFrame(rows, "model_family string, model_name string, split string, MAE double, RMSE double, R2 double")
    out["trials"] = store.write("trials", table)
    out["summary"] = store.summary(summary_df)
    out["metrics"] = store.metrics(summary_df.withColumnRenamed("model_family", "family"))
    test_scores = summary_df.filter(F.col("split") == "test").withColumnRenamed("model_family", "model")
    out["gate"] = store.write("gate", metrics.beats_baseline(test_scores, winner.family, "baseline"))
    slices = ev.get("slices", {})
    out["slices"] = store.slices(
        metrics.slices_multi(predictions, slices.get("group_cols", ["state", "zip_code"]), target, "pred_model", slices.get("min_count", 30), slices.get("topk", 20))
    )
    out["overview"] = store.overview(na_summary(df, [*NUMERIC, *CATEGORICAL, target], by=["split"]))
    out["window"] = store.write("window", date_window(df))
    out["training_rows"] = store.write("training_rows", used)
    return out


@_scratched
def run_single(
    sales: DataFrame, settings: Mapping[str, Any], store: RunStore, key: str, kind: str | None = None, params: Mapping[str, Any] | None = None, neighbor_mode: str | None = None
) -> dict[str, DataFrame]:
    """One model on a two-way split at ``split.cutoff``, or on a hashed split without dates."""
    spark = sales.sparkSession
    target, log, smearing = target_of(settings)
    neighbor_mode = neighbor_mode_of(settings, neighbor_mode)
    dated = "sold_date" in sales.columns
    df = model_frame(sales, settings)
    if dated:
        df = by_cutoff(df, settings.get("split", {}).get("cutoff", "2023-01-01"))
    else:
        fallback = settings.get("split", {}).get("random_fallback", {})
        df = by_hash(df, key, float(fallback.get("test_size", 0.2)), int(settings.get("run", {}).get("random_state", 0)))
    df = written(df, "features")
    train, test = part(df, "train"), part(df, "test")
    train_n, test_n, added = neighbors_from_settings(train, test, settings, target, neighbor_mode, symmetric=True) if dated else (train, test, [])
    numeric, categorical = choose_features(train_n, settings, added, test_n)
    model_settings = settings.get("model", {})
    kind = kind or model_settings.get("kind", "random_forest")
    family = resolve_kind(kind, settings)
    section = {"rf": "random_forest", "boosted": "xgboost"}.get(family, family)
    model = refit(train_n, family, params if params is not None else model_settings.get(section, {}), numeric, categorical, settings, target, log, smearing)
    predicted = written(model.predict(predict_baseline(test_n, fit_baseline(train, target))), "predictions")
    compared = metrics.compare_predictions(predicted, {"baseline": "pred_baseline", "model": "pred_model"}, target)
    model.save(store.model_path(family))
    out = {
        "predictions": store.predictions(predicted, "test", family, [key, *PREDICTION_COLUMNS]),
        "metrics": store.metrics(compared.withColumnRenamed("model", "family").withColumn("split", F.lit("test"))),
        "params": store.params(model.params_table(spark)),
    }
    importances = model.importances(spark)
    if importances is not None:
        out["importances"] = store.importances(importances, family)
    return out


@_scratched
def run_by_rmse(
    sales: DataFrame,
    settings: Mapping[str, Any],
    store: RunStore,
    key: str,
    kind: str | None = None,
    candidates: Sequence[Mapping[str, Any]] | None = None,
    neighbor_mode: str | None = None,
) -> dict[str, DataFrame]:
    """One family, chosen among candidates by validation RMSE; the test baseline knows train only.

    Family and candidates are those given, else ``model.kind`` and ``tune.grid`` (a list of
    parameter sets, or a grid) of the settings, else the defaults.
    """
    spark = sales.sparkSession
    section = settings["split"]
    target, log, smearing = target_of(settings)
    neighbor_mode = neighbor_mode_of(settings, neighbor_mode)
    kind = kind or settings.get("model", {}).get("kind", "xgboost")
    if candidates is None:
        asked = settings.get("tune", {}).get("grid")
        candidates = expand_grid(asked) if isinstance(asked, Mapping) else (asked or CANDIDATES)
    df = by_year(model_frame(sales, settings), section["train_max_year"], section["val_year"], section["test_min_year"])
    df = require_splits(written(df, "features"), {"train": 1, "val": 1, "test": 1})
    train, val, test, train_val = part(df, "train"), part(df, "val"), part(df, "test"), part(df, "train", "val")
    train_n, val_n, added = neighbors_from_settings(train, val, settings, target, neighbor_mode, symmetric=True)
    trv_n, test_n, added_test = neighbors_from_settings(train_val, test, settings, target, neighbor_mode, symmetric=True)
    numeric, categorical = choose_features(train_n, settings, added, val_n)
    family = resolve_kind(kind, settings)
    encoder = fit_encoder(train_n, numeric, categorical, settings)
    trials = sweep(train_n, val_n, encoder, {family: distinct_candidates(family, candidates)}, target, log, smearing)
    table = trial_table(spark, trials)
    best = trials[best_by_rmse(table).first()["trial_no"]]
    baseline = fit_baseline(train, target)
    numeric, categorical = choose_features(trv_n, settings, added_test, test_n)
    final = refit(trv_n, family, best.params, numeric, categorical, settings, target, log, smearing)
    parts = {
        "val": written(best.model.predict(predict_baseline(val_n, baseline)), "predictions"),
        "test": written(final.predict(predict_baseline(test_n, baseline)), "predictions"),
    }
    both = [
        metrics.compare_predictions(p, {"baseline": "pred_baseline", "model": "pred_model"}, target).withColumn("split", F.lit(name))
        for name, p in parts.items()
    ]
    final.save(store.model_path(family))
    out = {"trials": store.write("trials", table), "params": store.params(final.params_table(spark))}
    for name, p in parts.items():
        out[f"{name}_predictions"] = store.predictions(p, name, family, [key, *PREDICTION_COLUMNS])
    out["metrics"] = store.metrics(both[0].unionByName(both[1]).withColumnRenamed("model", "family"))
    importances = final.importances(spark)
    if importances is not None:
        out["importances"] = store.importances(importances, family)
    return out


def run_evaluation(predictions: DataFrame, settings: Mapping[str, Any], store: RunStore, key: str, target: str = "price") -> dict[str, DataFrame]:
    """Slices, calibration and calibration errors of a prediction table that was written before."""
    ev = settings.get("eval", {})
    slices = ev.get("slices", {})
    dims = list(slices.get("group_cols", ["state", "zip_code"]))
    single = metrics.slices_single(predictions, dims, target, "pred_model", slices.get("min_count", 10), slices.get("topk", 20))
    bins = store.calibration(calibration.quantile_bins(predictions, key, target, "pred_model", ev.get("calibration", {}).get("bins", 20)))
    return {
        "slices_single": store.slices(single, "slices_single"),
        "calibration": bins,
        "calibration_error": store.write("calibration_error", calibration.ece_weighted(bins)),
    }
