"""Column expressions: parsing, formatting and naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of a time that a plain cast does not understand.
TIME_FORMATS = [
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "yyyyMMdd HH:mm:ss",
    "MMM d, yyyy HH:mm:ss",
]


def parse_time(text: Column | str) -> Column:
    """Text in mixed formats to an instant; text that is no time gives null."""
    text = F.col(text) if isinstance(text, str) else text
    text = F.trim(text)
    tries = [text.try_cast("timestamp")]
    tries += [F.try_to_timestamp(text, F.lit(form)) for form in TIME_FORMATS]
    return F.coalesce(*tries)


def finite(value: Column) -> Column:
    """The value, or null when it is null, NaN or infinite."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ieee_ratio(top: Column, bottom: Column) -> Column:
    """Floating-point division that follows IEEE 754 instead of failing on zero."""
    on_zero = (
        F.when(F.isnan(top) | (top == 0), F.lit(float("nan")))
        .when(top > 0, F.lit(float("inf")))
        .when(top < 0, F.lit(float("-inf")))
    )
    return F.when(bottom == 0, on_zero).otherwise(F.try_divide(top, bottom))


def zero_or_missing(value: Column, default: Column) -> Column:
    """``default`` where the value is null, NaN or zero."""
    return F.when(value.isNull() | F.isnan(value) | (value == 0), default).otherwise(value)


def format_percent(value: Column) -> Column:
    """99.9 as ``99.90%``."""
    return F.format_string("%.2f%%", value)


def parse_percent(text: Column) -> Column:
    """``99.90%`` as 99.9; anything that is no number counts as 0."""
    return F.coalesce(F.regexp_replace(text, "%$", "").try_cast("double"), F.lit(0.0))


def clock_label(time: Column) -> Column:
    return F.date_format(time, "HH:mm")


def day_label(time: Column) -> Column:
    return F.date_format(time, "MMM d, HH:mm")


def millis_between(earlier: Column, later: Column) -> Column:
    return F.unix_millis(later.cast("timestamp")) - F.unix_millis(earlier.cast("timestamp"))


def topic_of(ticker: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.upper(ticker))


def split_model_file(name: Column) -> Column:
    """``AAPL_random_forest`` as struct(ticker, slug), cut at the first underscore."""
    parts = F.split(name, "_", 2)
    return F.struct(
        F.upper(F.get(parts, F.lit(0))).alias("ticker"), F.get(parts, F.lit(1)).alias("slug")
    )


def display_name(slug: Column) -> Column:
    """``random_forest`` as ``Random Forest``; a bare ``ensemble`` is the stacking one."""
    title = F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))
    return F.when(title == "Ensemble", F.lit("Stacking Ensemble")).otherwise(title)
