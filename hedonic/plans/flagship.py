"""The flagship query: an honest baseline, from raw tables to its error on a later year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators.groupstats import fit_baseline, predict_baseline
from hedonic.operators.metrics import regression_metrics
from hedonic.operators.split import part
from hedonic.plans.registry import query
from hedonic.plans.sales import MIN_GROUP, baseline_ctes, over, split_sales


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float columns: the last bits depend on the order of summation."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


@query(
    "flagship_baseline_error",
    over(
        "splits",
        """SELECT count(*) AS n, round(avg(abs(pred_baseline - price)), 4) AS "MAE",
                  round(sqrt(avg((pred_baseline - price) * (pred_baseline - price))), 4) AS "RMSE",
                  round(1 - sum((pred_baseline - price) * (pred_baseline - price)) / (var_pop(price) * count(*)), 8) AS "R2"
           FROM b""",
        *baseline_ctes("b", "split = 'train'", "split = 'val'", MIN_GROUP),
    ),
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir)
    fit = fit_baseline(part(df, "train"), min_group_size=MIN_GROUP)
    out = regression_metrics(predict_baseline(part(df, "val"), fit), "price", "pred_baseline")
    return rounded(rounded(out, 4, "MAE", "RMSE"), 8, "R2")
