"""Fits and whole runs on one numeric feature: ridge then has a closed form that SQL can follow.

The feature is ``bath`` with missing values filled by the fitted rows' median, the target a
logarithm, and the way back to dollars is smeared: slope = Sxy / (Sxx + alpha).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.models import encode, sweep
from hedonic.models.estimators import resolve_kind
from hedonic.operators import metrics
from hedonic.operators.split import part
from hedonic.plans.flagship import rounded
from hedonic.plans.q_evaluation import _metric_sql
from hedonic.plans.q_sinks import store
from hedonic.plans.registry import query
from hedonic.plans.sales import TEST_MIN, TRAIN_MAX, VAL_YEAR, baseline_ctes, over, sales, split_sales
from hedonic.session import durable, written
from hedonic.sinks.runs import RunStore

FEATURE = ["bath"]
SETTINGS = {"preprocess": {"numeric_imputer": "median"}}
# the second penalty is strong enough to change the slope
ALPHAS = (0.5, 50000.0)
GRID = {"ridge": [{"alpha": a} for a in ALPHAS]}
TRAIN, TRAIN_VAL = "split = 'train'", "split IN ('train', 'val')"
CUTOFF = "2000-07-01"


def _ridge(name: str, alpha: float | str, rows: str, base: str = "splits") -> list[str]:
    """Ridge fitted on ``rows`` of a relation and applied to all of it: columns pred and smear."""
    return [
        f"{name}_x AS (SELECT *, coalesce(bath, (SELECT median(bath) FROM {base} WHERE {rows})) AS x, ln(1 + price) AS y FROM {base})",
        f"{name}_s AS (SELECT avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) / (regr_sxx(y, x) + {alpha}) AS b FROM {name}_x WHERE {rows})",
        f"{name}_z AS (SELECT a.*, my + b * (x - mx) AS z FROM {name}_x a, {name}_s)",
        f"{name}_m AS (SELECT avg(exp(y - z)) AS smear FROM {name}_z WHERE {rows})",
        f"{name} AS (SELECT a.*, (exp(z) - 1) * smear AS pred, smear FROM {name}_z a, {name}_m)",
    ]


def _rounded(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, "MAE", "RMSE"), 8, "R2")


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(split_sales(spark, sf_dir).select("sale_key", "split", "price", *FEATURE), "features")


def _trials(spark: SparkSession, df: DataFrame) -> list[sweep.Trial]:
    encoder = encode.fit_encoder(part(df, "train"), FEATURE, [], SETTINGS)
    return sweep.sweep(part(df, "train"), part(df, "val"), encoder, GRID)


@query("fit_ridge", over("splits", f"SELECT 'ridge' AS family, split, count(*) AS n, {_metric_sql('pred')} FROM r WHERE split <> 'train' GROUP BY split", *_ridge("r", ALPHAS[1], TRAIN)))
def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir)
    model = sweep.refit(part(df, "train"), "ridge", GRID["ridge"][1], FEATURE, [], SETTINGS)
    out = metrics.regression_metrics(model.predict(part(df, "val", "test")), by=["split"])
    return _rounded(out.select(F.lit("ridge").alias("family"), "split", "n", "MAE", "RMSE", "R2"))


_TRIAL_SQL = " UNION ALL ".join(
    f"""SELECT CAST({i} AS INT) AS trial_no, 'ridge' AS family, '{{"alpha": {a}}}' AS params, {_metric_sql('pred')}, round(any_value(smear), 8) AS smear
        FROM r{i} WHERE split = 'val'"""
    for i, a in enumerate(ALPHAS)
)
_BOTH = [c for i, a in enumerate(ALPHAS) for c in _ridge(f"r{i}", a, TRAIN)]


@query("prep_fit_once", over("splits", f"SELECT trial_no, smear FROM ({_TRIAL_SQL})", *_BOTH))
def fit_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encoding, two trials on it."""
    return rounded(sweep.trial_table(spark, _trials(spark, frame(spark, sf_dir))).select("trial_no", "smear"), 8, "smear")


@query("sel_grid_sweep", over("splits", _TRIAL_SQL, *_BOTH))
def grid_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rounded(sweep.trial_table(spark, _trials(spark, frame(spark, sf_dir)))), 8, "smear")


_BEST = f"""best AS (SELECT CASE WHEN (SELECT "R2" FROM t WHERE trial_no = 1) > (SELECT "R2" FROM t WHERE trial_no = 0) THEN {ALPHAS[1]} ELSE {ALPHAS[0]} END AS alpha)"""
_SCORED = "t AS (" + " UNION ALL ".join(
    f"""SELECT {i} AS trial_no, 1 - sum((pred - price) * (pred - price)) / (var_pop(price) * count(*)) AS "R2",
        sqrt(avg((pred - price) * (pred - price))) AS "RMSE" FROM r{i} WHERE split = 'val'"""
    for i in range(len(ALPHAS))
) + ")"
_FINAL = [*_BOTH, _SCORED, _BEST, *_ridge("f", "(SELECT alpha FROM best)", TRAIN_VAL)]


@query("fit_refit_final", over("splits", f"SELECT 'ridge' AS family, split, count(*) AS n, {_metric_sql('pred')} FROM f WHERE split = 'test' GROUP BY split", *_FINAL))
def refit_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of two ridge trials on val, fitted again on train and val, scored on test."""
    df = frame(spark, sf_dir)
    trials = _trials(spark, df)
    winner = trials[sweep.best_overall(sweep.trial_table(spark, trials)).first()["trial_no"]]
    model = sweep.refit(part(df, "train", "val"), winner.family, winner.params, FEATURE, [], SETTINGS)
    out = metrics.regression_metrics(model.predict(part(df, "test")), by=["split"])
    return _rounded(out.select(F.lit(winner.family).alias("family"), "split", "n", "MAE", "RMSE", "R2"))


_KINDS = {"ridge": "ridge", "rf": "rf", "random_forest": "rf", "xgb": "boosted", "xgboost": "boosted", "auto": "boosted"}


@query(
    "fit_registry",
    over("splits", "SELECT kind, family, split, count(*) AS n FROM splits, (VALUES " + ", ".join(f"('{k}', '{f}')" for k, f in _KINDS.items()) + ") v(kind, family) WHERE split <> 'train' GROUP BY ALL"),
)
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each model name gives a fitted model of its family that predicts every row."""
    df = frame(spark, sf_dir)
    small = {"ridge": {"alpha": 1.0}, "rf": {"n_estimators": 2, "max_depth": 2}, "boosted": {"n_estimators": 2, "max_depth": 2}}
    models = sweep.refit_all(part(df, "train"), small, FEATURE, [], SETTINGS)
    out = None
    for kind in _KINDS:
        model = models[resolve_kind(kind)]
        rows = model.predict(part(df, "val", "test")).filter("pred_model IS NOT NULL").groupBy("split").agg(F.count(F.lit(1)).alias("n"))
        rows = rows.select(F.lit(kind).alias("kind"), F.lit(model.family).alias("family"), "split", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


# --- whole runs -------------------------------------------------------------------

RUN = {
    **SETTINGS,
    "split": {"train_max_year": TRAIN_MAX, "val_year": VAL_YEAR, "test_min_year": TEST_MIN, "cutoff": CUTOFF},
    "features": {"numeric": FEATURE, "categorical": [], "engineered": []},
    "model": {"kind": "ridge", "ridge": {"alpha": ALPHAS[1]}},
    "tune": {"grid": {"alpha": list(ALPHAS)}},
    "sweep": {"ridge": {"alpha": list(ALPHAS)}, "xgb": {"enabled": False}},
    "run": {"fast_sweep": True},
    "eval": {"slices": {"group_cols": ["state"], "min_count": 10, "topk": 5}},
}


def _run_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view for whole runs, without the raw texts that none of them reads."""
    return sales(spark, sf_dir).drop("price_raw", "zip_raw")


_RUN_BASELINES = [*baseline_ctes("bv", TRAIN, "split = 'val'"), *baseline_ctes("bt", TRAIN_VAL, "split = 'test'")]


@query(
    "run_sweep",
    over(
        "splits",
        f"""SELECT 'baseline' AS model_family, 'median_by_zip_year' AS model_name, 'val' AS split, {_metric_sql('pred_baseline')} FROM bv
            UNION ALL SELECT 'baseline', 'median_by_zip_year', 'test', {_metric_sql('pred_baseline')} FROM bt
            UNION ALL SELECT 'ridge', 'ridge', 'val', {_metric_sql('pred')} FROM (SELECT * FROM r0 WHERE (SELECT alpha FROM best) = {ALPHAS[0]} UNION ALL SELECT * FROM r1 WHERE (SELECT alpha FROM best) = {ALPHAS[1]}) WHERE split = 'val'
            UNION ALL SELECT 'ridge', 'ridge', 'test', {_metric_sql('pred')} FROM f WHERE split = 'test'""",
        *_FINAL,
        *_RUN_BASELINES,
    ),
)
def whole_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole sweep, with the grid of the settings: baseline and ridge on val and test."""
    return _rounded(sweep.run_sweep(_run_sales(spark, sf_dir), RUN, store(spark), "sale_key")["summary"].drop("run_id"))


_LONG = " UNION ALL ".join("""SELECT family, split, '{m}' AS metric, "{m}" AS value FROM w""".format(m=m) for m in ("MAE", "RMSE", "R2"))


def _long(df: DataFrame) -> DataFrame:
    digits = F.when(F.col("metric") == "R2", F.round("value", 8)).otherwise(F.round("value", 4))
    return df.select("family", "split", "metric", digits.alias("value"))


_BY_RMSE = f"""best AS (SELECT CASE WHEN (SELECT "RMSE" FROM t WHERE trial_no = 1) < (SELECT "RMSE" FROM t WHERE trial_no = 0) THEN {ALPHAS[1]} ELSE {ALPHAS[0]} END AS alpha)"""


@query(
    "run_by_rmse",
    over(
        "splits",
        _LONG,
        *_BOTH,
        _SCORED,
        _BY_RMSE,
        *_ridge("f", "(SELECT alpha FROM best)", TRAIN_VAL),
        *_ridge("g", "(SELECT alpha FROM best)", TRAIN),
        *baseline_ctes("b", TRAIN, "split <> 'train'"),
        f"""w AS (SELECT 'baseline' AS family, split, {_metric_sql('pred_baseline')} FROM b GROUP BY split
             UNION ALL SELECT 'model', split, {_metric_sql('pred')} FROM g WHERE split = 'val' GROUP BY split
             UNION ALL SELECT 'model', split, {_metric_sql('pred')} FROM f WHERE split = 'test' GROUP BY split)""",
    ),
)
def whole_by_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and grid come from the settings; chosen by RMSE on val, fitted again for test."""
    return _long(sweep.run_by_rmse(_run_sales(spark, sf_dir), RUN, store(spark), "sale_key")["metrics"])


_TWO = f"two AS (SELECT * EXCLUDE (split), CASE WHEN sold_date < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS split FROM splits)"


@query(
    "run_single",
    over(
        "splits",
        _LONG,
        _TWO,
        *_ridge("r", ALPHAS[1], TRAIN, "two"),
        *[c.replace("FROM splits", "FROM two") for c in baseline_ctes("b", TRAIN, "split = 'test'")],
        f"""w AS (SELECT 'baseline' AS family, split, {_metric_sql('pred_baseline')} FROM b GROUP BY split
             UNION ALL SELECT 'model', split, {_metric_sql('pred')} FROM r WHERE split = 'test' GROUP BY split)""",
    ),
)
def whole_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(sweep.run_single(_run_sales(spark, sf_dir), RUN, store(spark), "sale_key")["metrics"])


# --- run outputs written again ------------------------------------------------------


@query(
    "snk_run_rewrite",
    over("splits", "SELECT '007' AS run_id, 'one' AS family, split, count(*) AS n FROM splits GROUP BY split UNION ALL SELECT '20251201', family, split, count(*) FROM splits, (VALUES ('one'), ('two')) v(family) GROUP BY ALL"),
)
def run_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with number-like names; the first is written again with one family less, and an empty table replaces a full one."""
    base = f"{store(spark).base}"
    counts = durable(split_sales(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n")))  # written many times below
    for run_id, families in (("007", ["one", "two"]), ("20251201", ["one", "two"]), ("007", ["one"])):
        runs = RunStore(spark, base, run_id)
        for family in families:
            runs.write("counts", counts.withColumn("family", F.lit(family)), ["family"])
        runs.write("slices", counts if len(families) > 1 else counts.limit(0))
    left = runs.read("slices", "007").count()
    if left:
        raise AssertionError(f"{left} rows are left of an output that was written again without any")
    return runs.read("counts").select("run_id", "family", "split", "n")
