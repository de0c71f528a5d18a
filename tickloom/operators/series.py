"""Ordered per-ticker series that do not depend on one task per ticker.

A window over ``partitionBy("ticker")`` puts a whole ticker into one task.
That is right while every ticker is small.  A ticker above ``max_rows`` is cut
into *cells*: runs that are contiguous in (event_time, seq), each small enough
for a task.  A cell is named by its lower bound, so placing a row is plain
arithmetic after a join with the (short) table of cuts, and every stage of a
job that places a row again finds the same cell.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ORDER
from ..session import BROADCAST_ROWS, durable

MAX_SERIES_ROWS = 4_000_000

# About 200 MB of ticks and their features.
ROWS_PER_TASK = 2_000_000

CELL = ["cell_time", "cell_seq"]

# A cell too large is cut into this many slices for each max_rows it holds, so
# that uneven trading hours seldom call for another round.
_SLICES_PER_FILL = 4
_MIN_SLICES = 8


_SECOND = 1_000_000
_DAY = 86_400 * _SECOND


def _zoneless(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def micros(df: DataFrame, name: str = "event_time") -> Column:
    """Event time as a LONG in the order of the column.

    A zone-less time is taken apart instead of cast: a cast would go through
    the session's zone, where clock changes break the order.
    """
    time = F.col(name)
    if not _zoneless(df, name):
        return F.unix_micros(time)
    seconds = F.hour(time) * 3600 + F.minute(time) * 60
    fraction = (F.extract(F.lit("SECOND"), time) * _SECOND).cast("long")
    return day_number(df, name) * _DAY + seconds.cast("long") * _SECOND + fraction


def day_number(df: DataFrame, name: str = "event_time") -> Column:
    """Days since 1970, as a LONG."""
    if _zoneless(df, name):
        return F.unix_date(F.to_date(name)).cast("long")
    return F.floor(F.unix_micros(F.col(name)) / _DAY)


def start_of_day(df: DataFrame, day: int, name: str = "event_time") -> Column:
    """The first instant of a day number, as a constant of the column's type."""
    if _zoneless(df, name):
        return F.date_from_unix_date(F.lit(day)).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(day * _DAY))


#: Ranges of days that a scan is bounded by.
DAY_RANGES = 16


def day_ranges(spans: DataFrame, most: int = DAY_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of days that cover the spans (low, high), split where the gaps are widest.

    So one ticker that ended years ago does not make all others be read from there on.
    At most a row per calendar day reaches the driver.
    """
    by_day = spans.groupBy("low").agg(F.max("high").alias("high")).orderBy("low").collect()
    ranges: list[list[int]] = []
    for low, high in by_day:
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1][1] = max(ranges[-1][1], high)
        else:
            ranges.append([low, high])
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i - 1][1] - ranges[i][0])[: most - 1]
    starts = [0, *sorted(gaps)]
    ends = [*(i - 1 for i in starts[1:]), len(ranges) - 1]
    return [(ranges[a][0], ranges[b][1]) for a, b in zip(starts, ends)] if ranges else []


def in_days(df: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Rows of the days of some ranges: constants, which reach the scan, where files and row groups are skipped."""
    time, wanted = F.col("event_time"), F.lit(False)
    for low, high in ranges:
        wanted = wanted | ((time >= start_of_day(df, low)) & (time < start_of_day(df, high + 1)))
    return df.where(wanted)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with a ``seq`` each; one without fails the query, at every size of the data.

    Without it the order of equal times is open, and min_by and max_by pass the row over.
    """
    missing = F.raise_error(F.lit("a tick has no seq; number the lake with lake.with_seq"))
    return rows.withColumn("seq", F.when(F.col("seq").isNull(), missing.cast("long")).otherwise(F.col("seq")))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows that have a place in a series: those with a ticker and a time, which must have a ``seq``."""
    return numbered(rows.where(F.col("ticker").isNotNull() & F.col("event_time").isNotNull()))


#: Order of a series of ``tied`` rows.
TIED_ORDER = [*ORDER, "_tie"]


def tied(rows: DataFrame) -> DataFrame:
    """Add ``_tie``, a hash of the row: ticks with equal keys go by it, so only equal rows are interchangeable."""
    return rows.withColumn("_tie", F.xxhash64(*(F.col(c) for c in rows.columns)))


def small_side(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a stored table, once its size is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Size(NamedTuple):
    """Rows of the longest ticker and of all tickers; upper bounds will do."""

    longest: int
    total: int


def size_of(rows: DataFrame) -> Size:
    """Measured by one map-side count that reads the ticker only."""
    counts = rows.groupBy("ticker").agg(F.count("*").alias("n"))
    longest, total = counts.agg(F.max("n"), F.sum("n")).first()
    return Size(longest or 0, total or 0)


def spread(rows: DataFrame, size: Size, *keys: str) -> DataFrame:
    """Partition by the keys, with more tasks than the session's default if the data calls for it."""
    needed = ceil(size.total / ROWS_PER_TASK)
    if needed <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows
    return rows.repartition(needed, *keys)


def place_in_cells(rows: DataFrame, max_rows: int, size: Size) -> DataFrame | None:
    """Add the ``CELL`` columns; None when no ticker is longer than ``max_rows``."""
    if size.longest <= max_rows:
        return None
    whole = {"cell_time": F.lit(0).cast("long"), "cell_seq": F.lit(0).cast("long")}
    placed = rows.withColumns({**whole, "_micros": micros(rows)})
    pending = placed.select("ticker", *CELL, "_micros", "seq")
    while True:
        cuts = durable(_cuts(pending, max_rows))
        # Ticks that share event_time and seq cannot be told apart: they stay one cell, which is sorted on disk.
        cuts = cuts.where("width IS NOT NULL")
        if cuts.isEmpty():
            return placed.drop("_micros")
        cuts = small_side(cuts)
        placed = _cut(placed, cuts, "left")
        pending = _cut(pending, cuts, "inner")


def _cuts(pending: DataFrame, max_rows: int) -> DataFrame:
    """How to cut each cell that is too large: at most rows / max_rows of them.

    A cell is sliced evenly along time, or along seq once it is a single
    instant.  The approximate median is cut out on its own, which isolates an
    instant that holds most of a cell at the first attempt.
    """
    stats = (
        pending.groupBy("ticker", *CELL)
        .agg(
            F.count("*").alias("n"),
            F.min("_micros").alias("t0"),
            F.max("_micros").alias("t1"),
            F.min("seq").alias("s0"),
            F.max("seq").alias("s1"),
            F.percentile_approx("_micros", 0.5, 1000).alias("tm"),
            F.percentile_approx("seq", 0.5, 1000).alias("sm"),
        )
        .where(F.col("n") > max_rows)
    )
    by_time = F.col("t0") < F.col("t1")
    low = F.when(by_time, F.col("t0")).otherwise(F.col("s0"))
    span = F.when(by_time, F.col("t1") - F.col("t0")).otherwise(F.col("s1") - F.col("s0"))
    slices = F.greatest(
        F.lit(_MIN_SLICES), F.ceil(F.col("n") / F.lit(max_rows) * _SLICES_PER_FILL)
    ).cast("long")
    return stats.select(
        "ticker",
        *CELL,
        by_time.alias("by_time"),
        low.alias("low"),
        F.when(by_time, F.col("tm")).otherwise(F.col("sm")).alias("middle"),
        F.when(span > 0, F.ceil((span + 1) / slices).cast("long")).alias("width"),
    )


def _cut(df: DataFrame, cuts: DataFrame, how: str) -> DataFrame:
    joined = df.join(cuts, ["ticker", *CELL], how)
    at = F.when(F.col("by_time"), F.col("_micros")).otherwise(F.col("seq"))
    steps = (at - F.col("low")) - F.pmod(at - F.col("low"), F.col("width"))
    start = F.greatest(
        F.col("low") + steps,
        F.when(at > F.col("middle"), F.col("middle") + 1).when(
            at == F.col("middle"), F.col("middle")
        ),
    )
    return joined.withColumns(
        {
            "cell_time": F.when(F.col("by_time"), start).otherwise(F.col("cell_time")),
            "cell_seq": F.when(~F.col("by_time"), start).otherwise(F.col("cell_seq")),
        }
    ).select(*df.columns)


def number_rows(
    rows: DataFrame, max_rows: int = MAX_SERIES_ROWS, size: Size | None = None
) -> DataFrame:
    """Add ``row_no`` (from 1, in series order) and ``series_rows`` (series length).

    A known ``size`` saves a pass over rows that are costly to make.
    """
    rows = ordered(rows)
    size = size or size_of(rows)
    columns, rows = rows.columns, tied(rows)
    placed = place_in_cells(rows, max_rows, size)
    if placed is None:
        rows = spread(rows, size, "ticker")
        series = Window.partitionBy("ticker")
        return rows.select(
            *columns,
            F.row_number().over(series.orderBy(*TIED_ORDER)).cast("long").alias("row_no"),
            F.count("*").over(series).alias("series_rows"),
        )
    placed = spread(placed, size, "ticker", *CELL)
    # One row per cell, stored: the running sums below see only this short table.
    cells = durable(placed.groupBy("ticker", *CELL).agg(F.count("*").alias("_n")))
    series = Window.partitionBy("ticker")
    before = series.orderBy(*CELL).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "ticker",
        *CELL,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(series).alias("series_rows"),
    )
    in_cell = Window.partitionBy("ticker", *CELL).orderBy(*TIED_ORDER)
    return (
        placed.join(cells, ["ticker", *CELL])
        .withColumn("row_no", F.col("_before") + F.row_number().over(in_cell))
        .select(*columns, "row_no", "series_rows")
    )


def by_series(
    rows: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int,
    ahead: int,
    max_rows: int = MAX_SERIES_ROWS,
    size: Size | None = None,
) -> DataFrame:
    """``compute(rows, window)`` over the ordered series of each ticker.

    ``compute`` adds window columns and keeps the others; a row may depend on
    ``back`` rows before it and ``ahead`` rows after it.  One shuffle by ticker
    while the tickers are short.  Longer ones go by cells, also with one full
    shuffle: inside a cell, a row with enough rows on both sides is complete.
    Rows nearer to an edge are computed again from the rims, the first and last
    ``back + ahead`` rows of every cell lined up per ticker.  An edge row finds
    all its neighbours there, even across cells shorter than a rim.
    """
    rows = ordered(rows)
    size = size or size_of(rows)
    rows = tied(rows)
    placed = place_in_cells(rows, max_rows, size)
    series = Window.partitionBy("ticker").orderBy(*TIED_ORDER)
    if placed is None:
        return compute(spread(rows, size, "ticker"), series).drop("_tie")
    placed = spread(placed, size, "ticker", *CELL)
    in_cell = Window.partitionBy("ticker", *CELL).orderBy(*TIED_ORDER)

    def short_of(before: int, after: int) -> Column:
        first = F.lag("seq", before).over(in_cell).isNull() if before else F.lit(False)
        last = F.lead("seq", after).over(in_cell).isNull() if after else F.lit(False)
        return first | last

    edge = short_of(back, ahead).alias("_edge")
    rim = short_of(back + ahead, back + ahead).alias("_rim")
    inner = compute(placed.select("*", edge), in_cell).where(~F.col("_edge"))
    rims = placed.select("*", edge, rim).where("_rim").drop("_rim")
    outer = compute(rims, series).where("_edge")
    return inner.unionByName(outer).drop("_edge", "_tie", *CELL)
