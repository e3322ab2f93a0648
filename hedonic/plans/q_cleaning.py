"""Queries over cleaning and row-wise features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.functions import scalars
from hedonic.operators import clean, features
from hedonic.operators.split import part
from hedonic.plans.flagship import rounded
from hedonic.plans.registry import query
from hedonic.plans.sales import over, sales, split_sales
from hedonic.sources.load import load_sales

FILTERS = {
    "price": {"min": 2000.0, "max": 95000.0},
    "house_size": {"min": 150.0, "max_percentile": 99.0},
    "acre_lot": {"min": 0.0, "max_percentile": 90.0, "min_percentile": 5.0},
}

# price and house_size are filtered before the cap of house_size is taken, and both before acre_lot's
_FILTERED = [
    "f1 AS (SELECT * FROM sales WHERE price >= 2000.0 AND price <= 95000.0)",
    "f2 AS (SELECT * FROM f1 WHERE house_size >= 150.0)",
    "c2 AS (SELECT quantile_cont(house_size, 0.99) AS hi FROM f2)",
    """f3 AS (SELECT f2.* REPLACE (CASE WHEN house_size > (SELECT hi FROM c2) THEN (SELECT hi FROM c2) ELSE house_size END AS house_size)
              FROM f2 WHERE acre_lot >= 0.0)""",
    "c3 AS (SELECT quantile_cont(acre_lot, 0.9) AS hi, quantile_cont(acre_lot, 0.05) AS lo FROM f3)",
    """f4 AS (SELECT f3.* REPLACE (greatest(least(acre_lot, (SELECT hi FROM c3)), (SELECT lo FROM c3)) AS acre_lot) FROM f3)""",
]

_SANE = "NOT coalesce(bath > bed * 5 OR (bed = 0 AND bath > 0), false) AND NOT coalesce(house_size <= 100, false)"


@query("cln_trim", over("sales", "SELECT sale_key, trim(state) AS state, trim(city) AS city FROM sales"))
def trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", F.concat(F.lit(" "), "state", F.lit("  ")).alias("state"), F.concat("city", F.lit(" ")).alias("city"))
    return clean.trim_places(df)


_ZIP = "regexp_replace(regexp_replace(trim(zip_raw), '\\.0$', ''), '[^0-9]', '', 'g')"


@query(
    "cln_zip_normalize",
    over("sales", f"SELECT sale_key, CASE WHEN length({_ZIP}) BETWEEN 1 AND 5 THEN lpad({_ZIP}, 5, '0') ELSE {_ZIP} END AS zip FROM sales"),
)
def zip_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize_zips(sales(spark, sf_dir).select("sale_key", F.col("zip_raw").alias("zip")))


@query("cln_zip_light", over("sales", "SELECT sale_key, regexp_replace(trim(zip_raw), '\\.0$', '') AS zip FROM sales"))
def zip_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select("sale_key", scalars.zip_light(F.col("zip_raw")).alias("zip"))


@query(
    "cln_date_lenient",
    over(
        "sales",
        """SELECT sale_key, CASE WHEN substr(zip_code, 5, 1) = '9' THEN NULL
                  WHEN zip_code LIKE '%08' THEN date_trunc('month', sold_date)
                  WHEN zip_code LIKE '%7' AND zip_code NOT LIKE '%87' THEN date_trunc('minute', sold_date)
                  WHEN substr(zip_code, 5, 1) = '8' AND (property_id % 2 = 1 OR day(sold_date) > 12) OR substr(zip_code, 5, 1) IN ('0', '1', '2', '3', '4', '5')
                  THEN date_trunc('day', sold_date) ELSE date_trunc('second', sold_date) END AS sold
           FROM sales""",
    ),
)
def date_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in different ways, by the last digit of the ZIP; one way is no date at all."""
    digit, sold = F.substring("zip_code", 5, 1), F.col("sold_date")
    formats = {"0": "yyyy/MM/dd", "1": "MM/dd/yyyy", "2": "MMM d, yyyy", "3": "d MMMM yyyy", "4": "yyyyMMdd", "5": "yyyy-MM-dd", "6": "MM/dd/yyyy HH:mm:ss"}
    text = F.date_format(sold, "yyyy-MM-dd HH:mm:ss")
    for d, f in formats.items():
        text = F.when(digit == d, F.date_format(sold, f)).otherwise(text)
    # a month's name with a time, a two-digit year, the day first where it can be no month, year and month alone
    text = F.when((digit == "7") & ~F.col("zip_code").like("%87"), F.date_format(sold, "MMM d, yyyy HH:mm")).otherwise(text)
    text = F.when((digit == "8") & (F.col("property_id") % 2 == 1), F.date_format(sold, "MM/dd/yy")).otherwise(text)
    text = F.when((digit == "8") & (F.col("property_id") % 2 == 0) & (F.dayofmonth(sold) > 12), F.date_format(sold, "dd/MM/yyyy")).otherwise(text)
    text = F.when(F.col("zip_code").like("%08"), F.date_format(sold, "yyyy-MM")).otherwise(text)
    text = F.when(digit == "9", F.lit("no sale")).otherwise(text)
    df = sales(spark, sf_dir).select("sale_key", text.alias("sold"))
    return clean.coerce_dates(df, ["sold"])


@query("cln_date_strict", over("sales", "SELECT sale_key, CAST(sold_date AS DATE) AS sold_day FROM sales"))
def date_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", F.date_format("sold_date", "yyyy-MM-dd HH:mm:ss").alias("sold_date"))
    return clean.strict_dates(df).select("sale_key", F.col("sold_date").cast("date").alias("sold_day"))


@query(
    "cln_date_columns",
    over("sales", "SELECT sale_key, date_trunc('second', sold_date) AS sold_date, date_trunc('second', prev_sold_date) AS prev_sold_date, state FROM sales"),
)
def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", "sold_date", "prev_sold_date", "state")
    text = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in ("sold_date", "prev_sold_date")}
    return clean.coerce_date_columns(df.withColumns(text))


@query(
    "cln_inf_to_null",
    over("sales", "SELECT sale_key, CASE WHEN bath <> 0 THEN bed / bath END AS ratio, CASE WHEN acre_lot <> 0 THEN price / acre_lot END AS per_acre FROM sales"),
)
def inf_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios that divide by zero, as files from other tools hold them."""
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    df = sales(spark, sf_dir).select(
        "sale_key",
        F.when(F.col("bath") != 0, F.col("bed") / F.col("bath")).when(F.col("bed") > 0, inf).otherwise(nan).alias("ratio"),
        F.when(F.col("acre_lot") != 0, F.col("price") / F.col("acre_lot")).otherwise(-inf).alias("per_acre"),
    )
    return clean.inf_to_null(df)


@query("cln_price_parse", over("sales", "SELECT sale_key, TRY_CAST(regexp_replace(price_raw, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS price FROM sales"))
def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_price(sales(spark, sf_dir).select("sale_key", F.col("price_raw").alias("price")))


@query(
    "cln_int_parse",
    over(
        "sales",
        """SELECT sale_key, CAST(round_even(acre_lot / 4.0, 0) AS BIGINT) AS lots, CAST(year_built AS BIGINT) AS built,
                  TRY_CAST(trim(zip_raw) AS BIGINT) AS zip_number
           FROM sales""",
    ),
)
def int_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select(
        "sale_key",
        scalars.parse_int(F.col("acre_lot") / 4.0, T.DoubleType()).alias("lots"),
        scalars.parse_int(F.col("year_built"), T.IntegerType()).alias("built"),
        scalars.parse_int(F.col("zip_raw")).alias("zip_number"),
    )


@query(
    "cln_month_name",
    over(
        "sales",
        """SELECT sale_key, CAST(month(sold_date) AS INT) AS from_full, CAST(month(sold_date) AS INT) AS from_short, CAST(NULL AS INT) AS from_state
           FROM sales""",
    ),
)
def month_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    full, short = F.date_format("sold_date", "MMMM"), F.date_format("sold_date", "MMM")
    return sales(spark, sf_dir).select(
        "sale_key",
        scalars.month_number(F.upper(full)).alias("from_full"),
        scalars.month_number(F.concat(F.lit(" "), short)).alias("from_short"),
        scalars.month_number(F.col("state")).alias("from_state"),
    )


@query("cln_drop_null_date", over("sales", "SELECT sale_key, prev_sold_date FROM sales WHERE prev_sold_date IS NOT NULL"))
def drop_null_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select("sale_key", "prev_sold_date").na.drop(subset=["prev_sold_date"])


@query(
    "cln_drop_null_target",
    over(
        "sales",
        """SELECT sale_key, TRY_CAST(regexp_replace(price_raw, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS price FROM sales
           WHERE TRY_CAST(regexp_replace(price_raw, '[^0-9.\\-]', '', 'g') AS DOUBLE) IS NOT NULL""",
    ),
)
def drop_null_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = clean.clean_price(sales(spark, sf_dir).select("sale_key", F.col("price_raw").alias("price")))
    return df.na.drop(subset=["price"])


@query("cln_range_filter", over("sales", "SELECT sale_key, price, house_size FROM sales WHERE price >= 2000 AND price <= 95000 AND house_size >= 150"))
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"price": {"min": 2000.0, "max": 95000.0}, "house_size": {"min": 150.0}, "no_such_column": {"min": 1}}
    return clean.apply_filters(sales(spark, sf_dir).select("sale_key", "price", "house_size"), limits)


@query(
    "cln_percentile_cap",
    over("sales", "SELECT sale_key, round(price, 4) AS price, round(house_size, 4) AS house_size, round(acre_lot, 6) AS acre_lot FROM f4", *_FILTERED),
)
def percentile_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean.apply_filters(sales(spark, sf_dir).select("sale_key", "price", "house_size", "acre_lot"), FILTERS)
    return rounded(rounded(out, 4, "price", "house_size"), 6, "acre_lot")


@query(
    "cln_winsorize",
    over(
        "sales",
        """SELECT sale_key,
                  round(CASE WHEN house_size < hl THEN hl WHEN house_size > hh THEN hh ELSE house_size END, 4) AS house_size,
                  round(CASE WHEN price < pl THEN pl WHEN price > ph THEN ph ELSE price END, 4) AS price
           FROM sales, lim""",
        """lim AS (SELECT quantile_cont(house_size, 0.02) AS hl, quantile_cont(house_size, 0.97) AS hh,
                          quantile_cont(price, 0.02) AS pl, quantile_cont(price, 0.97) AS ph FROM sales)""",
    ),
)
def winsorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("sale_key", "house_size", "price", "state")
    out = clean.winsorize(df, ["house_size", "price", "state", "no_such_column"], 2.0, 97.0)
    return rounded(out.drop("state"), 4, "house_size", "price")


@query(
    "cln_winsorize_train",
    over(
        "splits",
        """SELECT sale_key, round(CASE WHEN house_size > hh THEN hh ELSE house_size END, 4) AS house_size
           FROM splits, lim""",
        "lim AS (SELECT quantile_cont(house_size, 0.0) AS hl, quantile_cont(house_size, 0.9) AS hh FROM splits WHERE split = 'train')",
    ),
)
def winsorize_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits taken from the training rows only, so that later sales do not shape them."""
    df = split_sales(spark, sf_dir).select("sale_key", "house_size", "split")
    return rounded(clean.winsorize(df, ["house_size"], 0.0, 90.0, fit_on=part(df, "train")).drop("split"), 4, "house_size")


@query("cln_sanity_drop", over("sales", f"SELECT sale_key, bed, bath, house_size FROM sales WHERE {_SANE}"))
def sanity_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.sanity_drop(sales(spark, sf_dir).select("sale_key", "bed", "bath", "house_size"))


_STEPS = [
    ("prev_sold_date known", "prev_sold_date IS NOT NULL"),
    ("price>=min", "price >= 2000.0"),
    ("price<=max", "price <= 95000.0"),
    ("house_size>=min", "house_size >= 150.0"),
    ("acre_lot>=min", "acre_lot >= 0.0"),
    ("bath_vs_bed", "NOT coalesce(bath > bed * 5 OR (bed = 0 AND bath > 0), false)"),
    ("house_size", "NOT coalesce(house_size <= 100, false)"),
]


def _audit_sql() -> str:
    selects, conditions = [], ["true"]
    for i, (name, condition) in enumerate(_STEPS, 1):
        before = " AND ".join(conditions)
        conditions.append(condition)
        selects.append(
            f"SELECT CAST({i} AS INT) AS step_no, '{name}' AS step, count(*) FILTER (WHERE {before}) AS rows_before, "
            f"count(*) FILTER (WHERE {' AND '.join(conditions)}) AS rows_after FROM sales"
        )
    return over("sales", " UNION ALL ".join(selects))


@query("cln_step_audit", _audit_sql())
def step_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir)
    rules = [("prev_sold_date known", F.col("prev_sold_date").isNotNull()), *clean.filter_rules(df, FILTERS), *clean.sanity_rules(df)]
    return clean.audit_rules(df, rules)


@query(
    "cln_load_all",
    over(
        "sales",
        f"""SELECT sale_key, round(price, 4) AS price, bed, bath, round(CASE WHEN house_size > hh THEN hh ELSE house_size END, 4) AS house_size,
                   CASE WHEN length(z) BETWEEN 1 AND 5 THEN lpad(z, 5, '0') ELSE z END AS zip_code, date_trunc('second', sold_date) AS sold_date
            FROM (SELECT *, {_ZIP} AS z FROM ok), lim""",
        """num AS (SELECT * REPLACE (TRY_CAST(regexp_replace(price_raw, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS price) FROM sales)""",
        "f1 AS (SELECT * FROM num WHERE price IS NOT NULL AND price >= 2000 AND price <= 95000)",
        "f2 AS (SELECT * FROM f1 WHERE house_size >= 150)",
        "cap AS (SELECT quantile_cont(house_size, 0.99) AS hi FROM f2)",
        "f3 AS (SELECT * REPLACE (CASE WHEN house_size > (SELECT hi FROM cap) THEN (SELECT hi FROM cap) ELSE house_size END AS house_size) FROM f2)",
        f"ok AS (SELECT * FROM f3 WHERE {_SANE})",
        "lim AS (SELECT quantile_cont(house_size, 0.95) AS hh FROM ok)",
    ),
)
def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table with other names, text dates, text prices and dirty ZIPs, cleaned in one go."""
    raw = sales(spark, sf_dir).select(
        F.col("sale_key").alias("Sale_Key"),
        F.date_format("sold_date", "yyyy-MM-dd HH:mm:ss").alias("Closing_Date"),
        F.col("zip_raw").alias(" ZIP"),
        F.col("price_raw").alias("Sale_Price"),
        F.col("house_size").alias("SqFt"),
        "bed",
        "bath",
    )
    settings = {
        "data": {
            "required_columns": ["price", "sold_date"],
            "filters": {"price": {"min": 2000, "max": 95000}, "house_size": {"min": 150, "max_percentile": 99.0}},
        },
        "features": {"winsorize": {"enabled": True, "columns": ["house_size"], "lower_pct": 0.0, "upper_pct": 95.0}},
    }
    out = load_sales(raw, settings).select("sale_key", "price", "bed", "bath", "house_size", "zip_code", "sold_date")
    return rounded(out, 4, "price", "house_size")


# --- features -----------------------------------------------------------------


@query("fea_calendar", over("dated", "SELECT sale_key, year, month FROM dated"))
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.calendar_features(sales(spark, sf_dir)).select("sale_key", "year", "month")


@query("fea_season", over("dated", "SELECT sale_key, CAST((month % 12) // 3 AS INT) AS season FROM dated"))
def season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.calendar_features(sales(spark, sf_dir)).select("sale_key", "season")


@query("fea_property_age", over("dated", "SELECT sale_key, CASE WHEN year - year_built >= 0 THEN CAST(year - year_built AS INT) END AS property_age FROM dated"))
def property_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.calendar_features(sales(spark, sf_dir)).select("sale_key", "property_age")


@query(
    "fea_years_since_prev",
    over(
        "sales",
        """SELECT sale_key, round(floor((epoch_us(sold_date) - epoch_us(prev_sold_date)) / 86400000000.0) / 365.25, 8) AS years_since_prev_sale
           FROM sales""",
    ),
)
def years_since_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.years_since_previous(sales(spark, sf_dir)).select("sale_key", "years_since_prev_sale")
    return rounded(out, 8, "years_since_prev_sale")


@query("fea_ensure_year", over("dated", "SELECT year, count(*) AS n FROM dated GROUP BY year"))
def ensure_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.ensure_year(features.ensure_year(sales(spark, sf_dir)))
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fea_expr",
    over(
        "sales",
        """SELECT sale_key, round(bed + bath, 6) AS rooms, round((bed + bath) * 2, 6) AS rooms_twice, CAST(7 AS INT) AS seven FROM sales""",
    ),
)
def expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered expressions, of which a later one uses an earlier one and one is a constant."""
    items = [{"name": "rooms", "expr": "bed + bath"}, {"name": "rooms_twice", "expr": "rooms * 2"}, {"name": "seven", "expr": "7"}]
    return features.add_expressions(sales(spark, sf_dir), items).select("sale_key", "rooms", "rooms_twice", "seven")


def _standard(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    items = [e for e in features.STANDARD_EXPRESSIONS if e["name"] == name]
    return rounded(features.add_expressions(sales(spark, sf_dir), items).select("sale_key", name), 9, name)


@query("fea_bed_per_bath", over("sales", "SELECT sale_key, round(bed / CASE WHEN bath < 1 THEN 1 ELSE bath END, 9) AS bed_per_bath FROM sales"))
def bed_per_bath(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standard(spark, sf_dir, "bed_per_bath")


@query("fea_lot_per_size", over("sales", "SELECT sale_key, round(acre_lot / CASE WHEN house_size < 1 THEN 1 ELSE house_size END, 9) AS lot_per_size FROM sales"))
def lot_per_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standard(spark, sf_dir, "lot_per_size")


@query("fea_log_house_size", over("sales", "SELECT sale_key, round(ln(1 + house_size), 9) AS log_house_size FROM sales"))
def log_house_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standard(spark, sf_dir, "log_house_size")


_WANTED = ["bed", "bath", "house_size", "acre_lot", "year", "month", "empty_col", "not_there"]


@query(
    "fea_usable_columns",
    over(
        "splits",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS train_values FROM splits WHERE split = 'train' HAVING count({c}) > 0" for c in _WANTED[:6]
        ),
    ),
)
def usable_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_sales(spark, sf_dir).withColumn("empty_col", F.lit(None).cast("double"))
    train, val = part(df, "train"), part(df, "val")
    usable = features.usable_columns(train, _WANTED, val)
    counts = train.agg(*[F.count(c).alias(c) for c in usable])
    return counts.unpivot([], usable, "column_name", "train_values")
