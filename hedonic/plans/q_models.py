"""Queries over feature preparation, model fitting and selection."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.models import encode, sweep
from hedonic.models.estimators import PriceModel, boosted_blocks, fit_encoded, resolve_kind
from hedonic.operators import metrics
from hedonic.operators.features import STANDARD_EXPRESSIONS, add_expressions, years_since_previous
from hedonic.operators.split import part
from hedonic.plans.flagship import rounded
from hedonic.plans.q_evaluation import ECE_WEIGHTED, QUANTILE_BINS
from hedonic.plans.q_sinks import store
from hedonic.plans.registry import query
from hedonic.plans.sales import MIN_GROUP, TEST_MIN, TRAIN_MAX, VAL_YEAR, over, predicted_sales, sales, split_sales
from hedonic.session import written

NUMERIC = ["bed", "bath", "acre_lot", "house_size", "year", "month", "season", "years_since_prev_sale", "property_age", "bed_per_bath", "log_house_size"]
CATEGORICAL = ["city", "state", "zip_code"]
RARE = 300  # rows a category needs for a column of its own
SETTINGS = {"preprocess": {"numeric_imputer": "median", "categorical_imputer": "most_frequent", "one_hot": {"min_frequency": RARE}}}
RIDGE, FOREST, BOOSTED = {"alpha": 1.0}, {"n_estimators": 10, "max_depth": 6, "min_samples_leaf": 2, "random_state": 0}, {
    "n_estimators": 8,
    "max_depth": 4,
    "learning_rate": 0.2,
    "subsample": 0.8,
    "random_state": 0,
}

_TRAIN = "tr AS (SELECT * FROM splits WHERE split = 'train')"


def frame(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """All features with the split, written once: every fit reads it. Queries that return no rows of it need no key and date."""
    df = add_expressions(years_since_previous(split_sales(spark, sf_dir)), STANDARD_EXPRESSIONS)
    kept = ["sale_key", "sold_date"] if keyed else []
    return written(df.select(*kept, "split", "price", *NUMERIC, *CATEGORICAL), "features")


def encoded(df: DataFrame) -> tuple[encode.FeatureEncoder, DataFrame]:
    encoder = encode.fit_encoder(part(df, "train"), NUMERIC, CATEGORICAL, SETTINGS)
    return encoder, encoder.transform(df)


def fitted(df: DataFrame, family: str, params: dict) -> PriceModel:
    return sweep.refit(part(df, "train"), family, params, NUMERIC, CATEGORICAL, SETTINGS)


def scored(df: DataFrame, model: PriceModel) -> DataFrame:
    """Errors on val and test; the values depend on the trainer, so they are not compared."""
    out = metrics.regression_metrics(model.predict(part(df, "val", "test")), by=["split"])
    return out.select(F.lit(model.family).alias("family"), "split", "n", "MAE", "RMSE", "R2")


# --- preparation ------------------------------------------------------------------


@query(
    "prep_impute_numeric",
    over(
        "splits",
        """SELECT sale_key, round(coalesce(bed, (SELECT median(bed) FROM tr)), 4) AS num_bed, round(coalesce(bath, (SELECT median(bath) FROM tr)), 4) AS num_bath,
                  round(coalesce(house_size, (SELECT median(house_size) FROM tr)), 4) AS num_house_size FROM splits""",
        _TRAIN,
    ),
)
def impute_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, columns = split_sales(spark, sf_dir), ["bed", "bath", "house_size"]
    fills = encode.numeric_fills(part(df, "train"), columns)
    out = encode.FeatureEncoder(columns, [], fills, {}, {}, {}).fill(df)
    return rounded(out.select("sale_key", "num_bed", "num_bath", "num_house_size"), 4, "num_bed", "num_bath", "num_house_size")


@query(
    "prep_impute_numeric_mean",
    over("splits", "SELECT sale_key, round(coalesce(house_size, (SELECT avg(house_size) FROM tr)), 4) AS by_mean, coalesce(house_size, -1.0) AS by_constant FROM splits", _TRAIN),
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, columns = split_sales(spark, sf_dir), ["house_size"]
    mean = encode.numeric_fills(part(df, "train"), columns, "mean")
    constant = encode.numeric_fills(part(df, "train"), columns, "constant", -1.0)
    for name, fills in (("by_mean", mean), ("by_constant", constant)):
        df = encode.FeatureEncoder(columns, [], fills, {}, {}, {}).fill(df).withColumnRenamed("num_house_size", name)
    return rounded(df.select("sale_key", "by_mean", "by_constant"), 4, "by_mean")


@query(
    "prep_impute_categorical",
    over(
        "splits",
        """SELECT sale_key, coalesce(city, (SELECT city FROM tr WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1)) AS cat_city,
                  state AS cat_state FROM splits""",
        _TRAIN,
    ),
)
def impute_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, columns = split_sales(spark, sf_dir), ["city", "state"]
    fills = encode.categorical_fills(encode.category_counts(part(df, "train"), columns), columns)
    return encode.FeatureEncoder([], columns, {}, {}, fills, {}).fill(df).select("sale_key", "cat_city", "cat_state")


@query(
    "prep_scale",
    over(
        "splits",
        """SELECT sale_key, round((f - (SELECT avg(f) FROM filled WHERE split = 'train')) / (SELECT stddev_pop(f) FROM filled WHERE split = 'train'), 8) AS num_house_size
           FROM filled""",
        _TRAIN,
        "filled AS (SELECT sale_key, split, coalesce(house_size, (SELECT median(house_size) FROM tr)) AS f FROM splits)",
    ),
)
def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir)
    encoder = encode.fit_encoder(part(df, "train"), ["house_size"], [], {"preprocess": {"scaler": "standard"}})
    return rounded(encoder.fill(df).select("sale_key", "num_house_size"), 8, "num_house_size")


@query(
    "prep_rare_bucket",
    over(
        "splits",
        f"""SELECT s.sale_key, CASE WHEN n.n IS NULL THEN NULL WHEN n.n < {RARE} THEN '__infrequent__' ELSE s.zip_code END AS bkt_zip_code,
                   CASE WHEN m.n IS NULL THEN NULL WHEN m.n < {RARE} THEN '__infrequent__' ELSE s.state END AS bkt_state
            FROM splits s LEFT JOIN (SELECT zip_code, count(*) AS n FROM tr GROUP BY 1) n ON s.zip_code = n.zip_code
            LEFT JOIN (SELECT state, count(*) AS n FROM tr GROUP BY 1) m ON s.state = m.state""",
        _TRAIN,
    ),
)
def rare_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir)
    encoder = encode.fit_encoder(part(df, "train"), ["bed"], ["zip_code", "state"], SETTINGS)
    return encoder.bucket(encoder.fill(df)).select("sale_key", "bkt_zip_code", "bkt_state")


_KNOWN = "coalesce(city, (SELECT city FROM tr WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1))"


@query(
    "prep_one_hot",
    over(
        "splits",
        f"""SELECT split, CAST(CASE WHEN {_KNOWN} IN (SELECT city FROM tr) THEN 1 ELSE 0 END
                  + CASE WHEN split <> 'test' AND state IN (SELECT state FROM tr) THEN 1 ELSE 0 END AS DOUBLE) AS filled, count(*) AS n
           FROM splits GROUP BY ALL""",
        _TRAIN,
    ),
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled positions per row: one for each category that training knows, none for others."""
    df = split_sales(spark, sf_dir)
    encoder = encode.fit_encoder(part(df, "train"), [], ["city", "state"], SETTINGS)
    vectors = encoder.transform(df.withColumn("state", F.when(F.col("split") == "test", F.lit("elsewhere")).otherwise(F.col("state"))))
    filled = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return vectors.groupBy("split", filled.alias("filled")).agg(F.count(F.lit(1)).alias("n"))


_SLOTS = " + ".join(
    f"""(SELECT count_if(n >= {RARE}) + CASE WHEN count_if(n < {RARE}) > 0 THEN 1 ELSE 0 END FROM (
         SELECT coalesce({c}, (SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS v, count(*) AS n FROM tr GROUP BY v))"""
    for c in CATEGORICAL
)


@query("prep_assemble", over("splits", f"SELECT sale_key, split, CAST({len(NUMERIC)} + {_SLOTS} AS INT) AS width FROM splits", _TRAIN))
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder, vectors = encoded(frame(spark, sf_dir))
    return vectors.select("sale_key", "split", F.size(vector_to_array("features")).alias("width"))


@query("prep_fit_once_wide")
def fit_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encoding, two trials on it."""
    df = frame(spark, sf_dir)
    encoder = encode.fit_encoder(part(df, "train"), NUMERIC, CATEGORICAL, SETTINGS)
    return sweep.trial_table(spark, sweep.sweep(part(df, "train"), part(df, "val"), encoder, {"ridge": [{"alpha": 0.5}, {"alpha": 5.0}]}))


# --- fitting ----------------------------------------------------------------------


@query("fit_ridge_wide")
def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir)
    return scored(df, fitted(df, "ridge", RIDGE))


@query("fit_forest")
def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir)
    return scored(df, fitted(df, "rf", FOREST))


@query("fit_boosted")
def boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir)
    return scored(df, fitted(df, "boosted", BOOSTED))


@query("fit_registry_wide")
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each model name resolved and fitted on the same vectors."""
    df = frame(spark, sf_dir)
    encoder, vectors = encoded(df)
    small = {"ridge": RIDGE, "rf": {**FOREST, "n_estimators": 3}, "boosted": {**BOOSTED, "n_estimators": 3}}
    train, out = part(vectors, "train"), None
    blocks, dense = boosted_blocks(train, encoder), encoder.dense(part(df, "train"))  # rows are binned once for all trees
    for kind in ("ridge", "random_forest", "xgboost", "auto"):
        family = resolve_kind(kind)
        spread = family == "rf" and dense
        rows = encoder.transform(encoder.spread(part(df, "train"))) if spread else train
        model = fit_encoded(family, small[family], rows, encoder, blocks=None if spread else blocks)
        rows = scored(df, model).withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out


_CANDIDATES = {"ridge": [{"alpha": 1.0}, {"alpha": 2.0}], "boosted": [{**BOOSTED, "max_depth": d} for d in (2, 4)]}


@query("sel_grid_sweep_wide")
def grid_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir)
    encoder = encode.fit_encoder(part(df, "train"), NUMERIC, CATEGORICAL, SETTINGS)
    return sweep.trial_table(spark, sweep.sweep(part(df, "train"), part(df, "val"), encoder, _CANDIDATES))


# Three formulas with two settings each stand for trials that SQL can score too.
_FORMULAS = [("flat", 0.0), ("flat", 5000.0), ("size", 12.0), ("size", 15.0), ("bed", 9000.0), ("bed", 12000.0)]


def _formula_column(i: int) -> Column:
    family, x = _FORMULAS[i]
    if family == "flat":
        return F.lit(50000.0 + x)
    base = F.coalesce("house_size", F.lit(1500.0)) if family == "size" else F.coalesce("bed", F.lit(2.0))
    return base * F.lit(x) + F.lit(20000.0)


def _formula_sql(i: int) -> str:
    family, x = _FORMULAS[i]
    if family == "flat":
        return f"{50000.0 + x}"
    base = "coalesce(house_size, 1500.0)" if family == "size" else "coalesce(bed, 2.0)"
    return f"{base} * {x} + 20000.0"


_TRIALS = "trials AS (" + " UNION ALL ".join(
    f"""SELECT CAST({i} AS INT) AS trial_no, '{f}' AS family, avg(abs(p - price)) AS "MAE", sqrt(avg((p - price) * (p - price))) AS "RMSE",
        1 - sum((p - price) * (p - price)) / (var_pop(price) * count(*)) AS "R2" FROM (SELECT price, {_formula_sql(i)} AS p FROM splits WHERE split = 'val')"""
    for i, (f, _) in enumerate(_FORMULAS)
) + ")"


def formula_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    val = part(split_sales(spark, sf_dir), "val")
    formulas = [F.struct(F.lit(i).alias("trial_no"), F.lit(f).alias("family"), _formula_column(i).alias("_p")) for i, (f, _) in enumerate(_FORMULAS)]
    long = val.select("price", F.inline(F.array(*formulas)))
    return metrics.regression_metrics(long, "price", "_p", ["trial_no", "family"]).drop("n")


def _rounded_scores(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, "MAE", "RMSE"), 8, "R2")


_SCORES = 'round("MAE", 4) AS "MAE", round("RMSE", 4) AS "RMSE", round("R2", 8) AS "R2"'


@query(
    "sel_best",
    over(
        "splits",
        f"""SELECT rule, trial_no, family, {_SCORES} FROM (
              SELECT 'family' AS rule, * FROM trials QUALIFY row_number() OVER (PARTITION BY family ORDER BY "R2" DESC, trial_no) = 1
              UNION ALL SELECT * FROM (SELECT 'overall' AS rule, * FROM trials ORDER BY "R2" DESC, trial_no LIMIT 1)
              UNION ALL SELECT * FROM (SELECT 'rmse' AS rule, * FROM trials ORDER BY "RMSE", "MAE" LIMIT 1))""",
        _TRIALS,
    ),
)
def best(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = formula_trials(spark, sf_dir)
    rules = {"family": sweep.best_per_family(trials), "overall": sweep.best_overall(trials), "rmse": sweep.best_by_rmse(trials)}
    out = None
    for rule, df in rules.items():
        rows = df.select(F.lit(rule).alias("rule"), "trial_no", "family", "MAE", "RMSE", "R2")
        out = rows if out is None else out.unionByName(rows)
    return _rounded_scores(out)


@query("fit_refit_final_wide")
def refit_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of two ridge trials on val, fitted again on train and val, scored on test."""
    df = frame(spark, sf_dir, keyed=False)
    encoder = encode.fit_encoder(part(df, "train"), NUMERIC, CATEGORICAL, SETTINGS)
    trials = sweep.sweep(part(df, "train"), part(df, "val"), encoder, {"ridge": [{"alpha": 1.0}, {"alpha": 2.0}]})
    winner = trials[sweep.best_overall(sweep.trial_table(spark, trials)).first()["trial_no"]]
    model = sweep.refit(part(df, "train", "val"), winner.family, winner.params, NUMERIC, CATEGORICAL, SETTINGS)
    return scored(part(df, "test"), model)


@query("fit_params_table_wide")
def params_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(frame(spark, sf_dir), "boosted", {**BOOSTED, "n_estimators": 3, "reg_lambda": 1.0}).params_table(spark)


@query("mdl_importances_wide")
def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(frame(spark, sf_dir), "rf", FOREST).importances(spark)


def _shares(df: DataFrame) -> DataFrame:
    """Importances add up to one, and each belongs to a source column."""
    unknown = F.count_if(~F.col("group").isin(*NUMERIC, *CATEGORICAL))
    return df.groupBy("family").agg(F.round(F.sum("importance"), 6).alias("total"), unknown.alias("unknown"))


@query("mdl_importances", "SELECT 'rf' AS family, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS unknown")
def importance_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(fitted(frame(spark, sf_dir), "rf", FOREST).importances(spark).withColumn("family", F.lit("rf")))


@query("snk_importances", "SELECT 'rf' AS family, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS unknown")
def sink_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(store(spark).importances(fitted(frame(spark, sf_dir), "rf", FOREST).importances(spark), "rf"))


@query(
    "fit_params_table",
    """SELECT 'boosted' AS family, * FROM (VALUES ('maxDepth', '4'), ('maxIter', '3'), ('not applied: early_stopping', '5'), ('reg_lambda', '1.0'),
       ('seed', '0'), ('stepSize', '0.2'), ('subsamplingRate', '0.8')) AS v(param, value)""",
)
def given_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given parameters as the trainer has them, and those that it cannot follow."""
    model = fitted(frame(spark, sf_dir), "boosted", {**BOOSTED, "n_estimators": 3, "reg_lambda": 1.0, "early_stopping": 5})
    names = ["maxIter", "maxDepth", "stepSize", "subsamplingRate", "seed", "reg_lambda"]
    return model.params_table(spark).filter(F.col("param").isin(*names) | F.col("param").startswith("not applied"))


@query("snk_model", over("splits", "SELECT split, count(*) AS n, CAST(0 AS DOUBLE) AS largest_difference FROM splits GROUP BY split"))
def sink_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved and loaded again predicts the same: largest difference per split."""
    df = frame(spark, sf_dir, keyed=False)
    model = fitted(df, "ridge", RIDGE)
    path = store(spark).model_path("ridge")
    model.save(path)
    again = PriceModel.load(spark, path)
    both = again.predict(model.predict(df, "first"), "second")
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("first") - F.col("second"))).alias("largest_difference"))


# --- whole runs -------------------------------------------------------------------

RUN_SETTINGS = {
    **SETTINGS,
    "split": {"train_max_year": TRAIN_MAX, "val_year": VAL_YEAR, "test_min_year": TEST_MIN, "cutoff": "2000-07-01"},
    "features": {
        "categorical": ["city", "state"],
        "leakage_safe_neighbors": {
            "enabled": True,
            "group_keys": ["zip_code", "year"],
            "stats": [{"kind": "median", "of": "price", "name": "zip_year_price_median"}],
            "min_group_size": MIN_GROUP,
        },
    },
    "eval": {"slices": {"group_cols": ["state"], "min_count": 10, "topk": 5}},
}


WIDE_SETTINGS = {**RUN_SETTINGS, "features": {**RUN_SETTINGS["features"], "categorical": CATEGORICAL}, "run": {"fast_sweep": True}}


@query("run_sweep_wide")
def whole_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fast sweep: the summary of baseline and families on val and test."""
    return sweep.run_sweep(sales(spark, sf_dir), WIDE_SETTINGS, store(spark), "sale_key", neighbor_mode="asof")["summary"]


@query("run_single_wide")
def whole_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.run_single(sales(spark, sf_dir), RUN_SETTINGS, store(spark), "sale_key", "random_forest", {**FOREST, "n_estimators": 5})["metrics"]


@query("run_by_rmse_wide")
def whole_by_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.run_by_rmse(sales(spark, sf_dir), WIDE_SETTINGS, store(spark), "sale_key", "xgboost", sweep.CANDIDATES)["metrics"]


@query("run_evaluation", over("preds", ECE_WEIGHTED, *QUANTILE_BINS))
def whole_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation of predictions that were written before: here the calibration error."""
    runs = store(spark)
    written_before = runs.predictions(predicted_sales(spark, sf_dir), "test", "formula", ["sale_key", "state", "zip_code", "price"])
    out = sweep.run_evaluation(written_before, RUN_SETTINGS, runs, "sale_key")["calibration_error"].drop("run_id")
    return rounded(rounded(out, 4, "ECE_abs"), 8, "ECE_rel")
