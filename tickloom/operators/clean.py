"""Filters, fills, duplicates and small selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import zero_or_missing
from ..schema import FEATURES, MIN_TRAIN_ROWS
from ..session import durable
from .ranks import cuts
from .series import TIED_ORDER, Size, day_number, day_ranges, in_days, micros, number_rows, numbered, ordered, size_of, small_side, tied


def one_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """Exact-case equality; prunes partitions when the lake is scanned."""
    return df.where(F.col("ticker") == ticker)


def distinct_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct()


def fill_zero(df: DataFrame) -> DataFrame:
    """Null and NaN become 0 in every numeric column."""
    return df.fillna(0)


def first_per_time(df: DataFrame) -> DataFrame:
    """One row per (ticker, event_time): the one with the lowest seq.

    An aggregate, not a ranking: copies are merged before the shuffle, so a
    time that repeats without end never meets in one task.
    """
    rest = [name for name in df.columns if name not in ("ticker", "event_time")]
    first = F.min_by(F.struct(*rest), F.struct("seq", "_tie")).alias("_first")
    kept = tied(numbered(df)).groupBy("ticker", "event_time").agg(first).select("ticker", "event_time", "_first.*")
    return kept.select(*df.columns)


def min_rows(df: DataFrame, at_least: int = MIN_TRAIN_ROWS) -> DataFrame:
    """Rows of tickers that have at least ``at_least`` rows.

    The counts are stored first, so that a list of tickers of a moderate size
    filters the rows where they are, without a shuffle.
    """
    counts = df.groupBy("ticker").agg(F.count("*").alias("_n"))
    enough = durable(counts.where(F.col("_n") >= at_least).select("ticker"))
    return df.join(small_side(enough), "ticker", "left_semi")


def latest(ticks: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """The last tick of every ticker.

    The last times come first, from two columns only, or from a ``summary`` by day
    (ticker, last_time).  They are then looked up, skipping files without one of
    their days.  (Carrying whole rows through one aggregate would sort all ticks.)
    """
    known = ordered(ticks)
    if summary is None:
        last = durable(known.groupBy("ticker").agg(F.max("event_time").alias("event_time")))
    else:
        last = durable(summary.groupBy("ticker").agg(F.max("last_time").alias("event_time")))
    day = day_number(last)
    known = in_days(known, day_ranges(last.select(day.alias("low"), day.alias("high"))))
    rest = [name for name in ticks.columns if name not in ("ticker", "event_time")]
    at_last = known.join(small_side(last), ["ticker", "event_time"])
    newest = F.max_by(F.struct(*rest), F.struct("seq", "_tie")).alias("_newest")
    found = tied(at_last).groupBy("ticker", "event_time").agg(newest)
    return found.select("ticker", "event_time", "_newest.*").select(*ticks.columns)


# Beyond this the optimizer no longer limits a ranking before the shuffle.
_TOP_N = 1000


#: Rows of a ticker that are ranked in one task.
TAIL_ROWS = 200_000


def last_n(df: DataFrame, n: int, size: Size | None = None, tail_rows: int = TAIL_ROWS) -> DataFrame:
    """The last ``n`` rows of every ticker.

    The rank filter is a top-n for the optimizer: each task passes on at most
    ``n`` rows per ticker.  Of a ticker of more than ``tail_rows`` rows the rows before a
    cut, found by counts, are left out first, so the tasks pass on a bounded number
    together.  A large ``n`` goes by row numbers instead.
    """
    size = size or size_of(df)
    if n > _TOP_N:
        numbered = number_rows(df, size=size)
        newest_rows = numbered.where(F.col("row_no") > F.col("series_rows") - n)
        return newest_rows.drop("row_no", "series_rows")
    newest = Window.partitionBy("ticker").orderBy(*(F.desc(k) for k in TIED_ORDER))
    if size.longest > tail_rows:
        df = from_cut(ordered(df), n, tail_rows)
    ranked = tied(ordered(df)).withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= n).drop("_rank", "_tie")


def from_cut(rows: DataFrame, n: int, tail_rows: int) -> DataFrame:
    """The last ``n`` rows of every ticker, and at most about ``tail_rows`` before them."""
    placed = rows.withColumns({"_a": micros(rows), "_b": F.col("seq")})
    found = cuts(placed.select("ticker", "_a", "_b"), F.lit(n), tail_rows)
    low = found.select("ticker", F.col("a").alias("_low_a"), F.col("b").alias("_low_b"))
    after = (F.col("_a") > F.col("_low_a")) | ((F.col("_a") == F.col("_low_a")) & (F.col("_b") >= F.col("_low_b")))
    return placed.join(small_side(low), "ticker").where(after).select(*rows.columns)


def last_of_series(df: DataFrame, ticker: str, n: int) -> DataFrame:
    """The last ``n`` rows of one ticker, oldest first."""
    newest = one_ticker(df, ticker).orderBy(F.desc("event_time"), F.desc("seq")).limit(n)
    return newest.orderBy("event_time", "seq")


# Features that fall back to the price, not to 0.
_PRICE_LIKE = ["MA5", "MA10", "MA20", "rolling_mean"]


def request_defaults(df: DataFrame) -> DataFrame:
    """Feature columns made complete for a prediction request.

    A missing or zero average becomes the price, any other missing feature 0.
    Rows whose price itself is missing or zero are left out.
    """
    priced = df.where(F.col("price").isNotNull() & ~F.isnan("price") & (F.col("price") != 0))
    filled = {}
    for name in FEATURES[1:]:
        kind = priced.schema[name].dataType
        default = F.col("price") if name in _PRICE_LIKE else F.lit(0)
        filled[name] = zero_or_missing(F.col(name), default).cast(kind)
    return priced.withColumns(filled)
