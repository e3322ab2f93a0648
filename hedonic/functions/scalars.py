"""Column expressions for cleaning and deriving values; all run inside the JVM."""

from __future__ import annotations

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}([ T]|$)"
_ISO_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_SLASHED_YEAR_FIRST = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
_SLASHED_YEAR_LAST = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
_SLASHED_SHORT_YEAR = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2})(?=[ T]|$)"
_YEAR_MONTH = r"^(\d{4})[-/](\d{1,2})$"
_OTHER_NUMERIC = r"^(\d{4}/\d{1,2}/\d{1,2}|\d{1,2}[/-]\d{1,2}[/-](\d{4}|\d{2}))([ T]|$)|^\d{8}$|^\d{4}[-/]\d{1,2}$"
# a time of day at the end, after a date with a month name
_CLOCK_AT_END = r"[ ,T]+(\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)$"
_CENTURY_TURN = 69  # two-digit years from here on are of the twentieth century
# date patterns with a month name, tried after the numeric forms
_NAMED_MONTH = r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec).*\d{4}"
_NAMED_MONTH_FORMATS = ["MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d yyyy", "MMMM d yyyy"]


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def finite(c: Column) -> Column:
    """NULL for NaN and infinities (NaN sorts above infinity, so one comparison per side does)."""
    return F.when((c < float("inf")) & (c > float("-inf")), c)


def clip(c: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """``c`` limited to [low, high]; NULL stays NULL, unlike with greatest and least."""
    low = F.lit(low) if isinstance(low, (int, float)) else low
    high = F.lit(high) if isinstance(high, (int, float)) else high
    out = c
    if low is not None:
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        out = F.when(out > high, high).otherwise(out)
    return out


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def zip_light(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """The ZIP as trimmed text without a trailing ``.0``."""
    text = c.cast("string")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = F.when(c == F.floor(c), F.floor(c).cast("long").cast("string")).otherwise(text)
    return F.regexp_replace(F.trim(text), r"\.0$", "")


def zip_normalize(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """ZIP digits, left-padded to five when there are one to five of them."""
    text = F.floor(c).cast("long").cast("string") if is_numeric(dtype) else c.cast("string")
    digits = F.regexp_replace(F.regexp_replace(F.trim(text), r"\.0$", ""), r"[^0-9]", "")
    # lpad cuts longer text, so it may only see short ones
    return F.when(F.length(digits).between(1, 5), F.lpad(digits, 5, "0")).otherwise(digits)


def parse_price(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Currency-like text as a double; what is left over and no number becomes NULL."""
    if is_numeric(dtype):
        return c.cast("double")
    return F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "").try_cast("double")


def parse_int(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Whole numbers: floats round half to even, text must be whole or no number at all."""
    if isinstance(dtype, T.IntegralType):
        return c.cast("long")
    if is_numeric(dtype):
        return F.bround(finite(c.cast("double")), 0).cast("long")
    number = finite(F.trim(c.cast("string")).try_cast("double"))
    fractional = F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string"))).cast("long")
    return F.when(number != F.floor(number), fractional).otherwise(number.cast("long"))


def month_number(c: Column) -> Column:
    """1 to 12 for an English month name or its short form, else NULL."""
    names = {}
    for number in range(1, 13):
        full = calendar.month_name[number].lower()
        names[full] = number
        names[full[:3]] = number
    names["sept"] = 9
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return lookup[F.lower(F.trim(c.cast("string")))]


def parse_timestamp(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """A timestamp without time zone from mixed formats; what does not parse is NULL.

    Text is brought into ISO order and cast, which needs no session time zone.
    Numbers in text are no dates unless they are yyyymmdd; numeric columns count nanoseconds.
    """
    if is_temporal(dtype):
        return c.cast("timestamp_ntz")
    if is_numeric(dtype):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return epoch + F.make_dt_interval(secs=(c / F.lit(1e9)).cast("decimal(18,6)"))
    text = F.trim(c.cast("string"))
    full_year = _with_full_year(text)
    # the first number is the month unless it cannot be one
    first, second = (F.regexp_extract(full_year, _SLASHED_YEAR_LAST, g).try_cast("int") for g in (1, 2))
    day_first = F.coalesce((first > 12) & (second <= 12), F.lit(False))
    year_last = F.when(day_first, F.regexp_replace(full_year, _SLASHED_YEAR_LAST, "$3-$2-$1")).otherwise(F.regexp_replace(full_year, _SLASHED_YEAR_LAST, "$3-$1-$2"))
    iso = F.regexp_replace(year_last, _SLASHED_YEAR_FIRST, "$1-$2-$3")
    iso = F.regexp_replace(iso, _ISO_COMPACT, "$1-$2-$3")
    iso = F.regexp_replace(iso, _YEAR_MONTH, "$1-$2-01")
    # the usual form first and cheapest; a format that does not match costs an exception
    return (
        F.when(text.rlike(_ISO_START), text.try_cast("timestamp_ntz"))
        .when(text.rlike(_OTHER_NUMERIC), iso.try_cast("timestamp_ntz"))
        .when(text.rlike(_NAMED_MONTH), _named_month(text))
    )


def _with_full_year(text: Column) -> Column:
    """Dates with two-digit years last, their years written in full."""
    short = F.regexp_extract(text, _SLASHED_SHORT_YEAR, 3).try_cast("int")
    century = F.when(short >= _CENTURY_TURN, "19").otherwise("20")
    day_and_month = F.regexp_replace(F.regexp_extract(text, _SLASHED_SHORT_YEAR, 0), r"\d{2}$", "")
    rest = F.regexp_replace(text, _SLASHED_SHORT_YEAR, "")
    return F.when(short.isNotNull(), F.concat(day_and_month, century, F.lpad(short.cast("string"), 2, "0"), rest)).otherwise(text)


def _named_month(text: Column) -> Column:
    """Dates with a month's name, with or without a time of day after them."""
    clock = F.regexp_extract(text, _CLOCK_AT_END, 1)
    date = F.regexp_replace(text, _CLOCK_AT_END, "")
    day = F.coalesce(*[F.try_to_date(date, fmt) for fmt in _NAMED_MONTH_FORMATS])
    padded = F.when(F.length(F.element_at(F.split(clock, ":"), 1)) == 1, F.concat(F.lit("0"), clock)).otherwise(clock)
    return F.when(clock == "", day.cast("timestamp_ntz")).otherwise(F.concat_ws(" ", day.cast("string"), padded).try_cast("timestamp_ntz"))


def season(month: Column) -> Column:
    """0 for December to February, then one step per three months."""
    return F.floor(F.pmod(month, F.lit(12)) / 3).cast("int")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down (also below zero)."""
    later, earlier = later.cast("timestamp_ntz"), earlier.cast("timestamp_ntz")
    day_later, day_earlier = later.cast("date"), earlier.cast("date")
    clock_later = later - day_later.cast("timestamp_ntz")
    clock_earlier = earlier - day_earlier.cast("timestamp_ntz")
    return F.datediff(day_later, day_earlier) - F.when(clock_later < clock_earlier, 1).otherwise(0)


def usd_label(c: Column) -> Column:
    """Dollars with thousands separators and no cents; NULL becomes a dash."""
    sign = F.when(F.bround(c, 0) < 0, "-").otherwise("")
    text = F.concat(F.lit("$"), sign, F.format_number(F.abs(F.bround(c, 0)), 0))
    return F.coalesce(text, F.lit("—"))


def slice_label(value: Column, n: Column) -> Column:
    return F.concat(value, F.lit(" (n="), n.cast("string"), F.lit(")"))
