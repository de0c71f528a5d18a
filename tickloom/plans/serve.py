"""The reads a dashboard needs, for all tickers in one job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.clean import fill_zero, first_per_time, last_n
from ..operators.features import LOOKBACK, SERVING, Profile, features
from ..operators.series import (
    MAX_SERIES_ROWS,
    Size,
    day_number,
    day_ranges,
    in_days,
    ordered,
    small_side,
)
from ..schema import DEFAULT_MODELS
from ..session import BROADCAST_ROWS, durable
from ..sources.metrics import no_metrics, read_metrics, read_metrics_document


def recent(
    ticks: DataFrame,
    n: int = 100,
    profile: Profile = SERVING,
    max_rows: int = MAX_SERIES_ROWS,
    summary: DataFrame | None = None,
) -> DataFrame:
    """The last ``n`` feature rows of every ticker, one per time.

    Features need 19 ticks of context, not the whole history.  A count per
    ticker and day, merged before the shuffle, tells from which day on to read.
    Where those days turn out too few (many copies, many incomplete rows) they
    are widened until every ticker has its rows or its whole history is read.
    With a ``summary`` (ticker, day, n), as ``streaming.sinks.days`` keeps it, no
    other day is looked at.
    """
    rows = ordered(ticks)
    rows = rows.withColumn("_day", day_number(rows))
    if summary is None:
        days = durable(rows.groupBy("ticker", "_day").agg(F.count("*").alias("n")))
    else:
        days = durable(summary.select("ticker", F.col("day").alias("_day"), "n"))
    wanted = n + profile.horizon
    found = None
    while True:
        starts = _start_days(days, wanted)
        part = durable(_recent_part(rows, starts, n, profile, max_rows))
        found = part if found is None else found.unionByName(part)
        full = part.groupBy("ticker").count().where(F.col("count") >= n)
        short = starts.where("keep_from > first_day").join(full, "ticker", "left_anti")
        if short.isEmpty():
            return fill_zero(found)
        again = small_side(durable(short.select("ticker")))
        found = found.join(again, "ticker", "left_anti")
        rows = rows.join(again, "ticker", "left_semi")
        days = days.join(again, "ticker", "left_semi")
        wanted *= 8


def _start_days(days: DataFrame, wanted: int) -> DataFrame:
    """Per ticker: from which day rows are kept, and from which day to read.

    The days from ``keep_from`` on hold at least ``wanted`` ticks, those from
    ``read_from`` on the context as well.  ``to_read`` ticks are read.
    """
    series = Window.partitionBy("ticker")
    since = F.sum("n").over(series.orderBy(F.desc("_day")))
    counted = days.select("ticker", "_day", since.alias("since"))
    keep_from = F.max(F.when(F.col("since") >= wanted, F.col("_day"))).over(series)
    first_day = F.min("_day").over(series)
    kept = counted.select(
        "*", first_day.alias("first_day"), F.coalesce(keep_from, first_day).alias("keep_from")
    )
    kept_rows = F.max(F.when(F.col("_day") == F.col("keep_from"), F.col("since"))).over(series)
    read = kept.withColumn("enough", F.col("since") >= kept_rows + LOOKBACK)
    return read.groupBy("ticker", "keep_from", "first_day").agg(
        F.max("_day").alias("last_day"),
        F.coalesce(F.max(F.when(F.col("enough"), F.col("_day"))), F.col("first_day")).alias(
            "read_from"
        ),
        F.coalesce(F.min(F.when(F.col("enough"), F.col("since"))), F.max("since")).alias("to_read"),
    )


def _recent_part(
    rows: DataFrame, starts: DataFrame, n: int, profile: Profile, max_rows: int
) -> DataFrame:
    starts = durable(starts)
    longest, total, tickers = starts.agg(F.max("to_read"), F.sum("to_read"), F.count("*")).first()
    spans = starts.select(F.col("read_from").alias("low"), F.col("last_day").alias("high"))
    tail = in_days(rows, day_ranges(spans))
    limits = starts.select("ticker", "read_from", "keep_from")
    limits = F.broadcast(limits) if tickers <= BROADCAST_ROWS else limits
    tail = tail.join(limits, "ticker").where("_day >= read_from").drop("read_from")
    made = features(tail, profile, max_rows, Size(longest or 0, total or 0))
    made = made.where("_day >= keep_from").drop("_day", "keep_from")
    return last_n(first_per_time(made), n, Size(longest or 0, total or 0))


def records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, for a caller that wants records."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def band(model: Column, prediction: Column) -> dict[str, Column]:
    """The published price and its band: 1 % around an ensemble, 2 % around others."""
    width = F.when(model.contains("Ensemble"), F.lit(0.01)).otherwise(F.lit(0.02))
    return {
        "predicted_price": F.round(prediction, 2),
        "confidence_lower": F.round(prediction * (1 - width), 2),
        "confidence_upper": F.round(prediction * (1 + width), 2),
    }


def with_band(predictions: DataFrame) -> DataFrame:
    return predictions.withColumns(band(F.col("model"), F.col("prediction")))


def direction(predicted: Column, current: Column) -> Column:
    """UP if the published prediction is above the price; equal or missing is DOWN."""
    return F.when(predicted > current, F.lit("UP")).otherwise(F.lit("DOWN"))


def market_state(ticks: DataFrame, as_of: datetime | str, idle: str = "15 minutes", summary: DataFrame | None = None) -> DataFrame:
    """CLOSED where the last tick is older than ``idle`` at ``as_of``; from a ``summary`` by day alone, if there is one."""
    if summary is None:
        last = ordered(ticks).groupBy("ticker").agg(F.max("event_time").alias("last_tick"))
    else:
        last = summary.groupBy("ticker").agg(F.max("last_time").alias("last_tick"))
    now = F.lit(as_of).cast(last.schema["last_tick"].dataType)
    closed = F.col("last_tick") < now - F.expr(f"INTERVAL {idle}")
    return last.withColumn("state", F.when(closed, F.lit("CLOSED")).otherwise(F.lit("OPEN")))


def market_state_of(ticks: DataFrame, tickers: DataFrame, as_of: datetime | str) -> DataFrame:
    """The state of each requested ticker; one without ticks counts as open."""
    known = market_state(ticks, as_of)
    return tickers.join(known, "ticker", "left").withColumn(
        "state", F.coalesce("state", F.lit("OPEN"))
    )


def default_metrics(tickers: DataFrame) -> DataFrame:
    """``N/A`` for each of the usual models."""
    models = F.explode(F.array(*(F.lit(name) for name in DEFAULT_MODELS))).alias("model")
    return tickers.select(F.upper("ticker").alias("ticker"), models).withColumn(
        "accuracy", F.lit("N/A")
    )


def metrics_of(published: DataFrame, tickers: DataFrame) -> DataFrame:
    """Published metrics of the tickers asked for; the usual models for one without any."""
    asked = tickers.select(F.upper("ticker").alias("ticker")).distinct()
    known = published.join(asked, "ticker", "left_semi").select("ticker", "model", "accuracy")
    unknown = asked.join(published, "ticker", "left_anti")
    return known.unionByName(default_metrics(unknown))


def metrics_lookup(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    """Metrics of one ticker from a stored file.

    No file: the usual models with ``N/A``.  Unknown ticker: no rows.  A file
    that does not parse: one row with the model null and the text ``error``.
    """
    asked = spark.range(1).select(F.lit(ticker).alias("ticker"))
    if no_metrics(spark, path):
        return default_metrics(asked)
    stored = read_metrics_document(spark, path) if path.endswith(".json") else read_metrics(spark, path)
    broken = stored.where(F.col("ticker").isNull()).limit(1)
    broken = broken.select(F.lit(ticker.upper()).alias("ticker"), "model").withColumn("accuracy", F.lit("error"))
    return stored.where(F.col("ticker") == ticker.upper()).unionByName(broken)
