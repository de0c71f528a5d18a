"""The row of a given rank of every ticker, by counts over ranges instead of a sort.

The values of a ticker are pairs of LONGs, (a, b), in their order.  The range that holds the
wanted row is cut into ``SLICES`` even ones, their rows are counted, and the one that holds
it is cut again, along a and, once that is a single value, along b.  A round is one
map-side aggregate over all tickers, so no task gets more than a count for each slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .series import small_side

SLICES = 1024


def _sliced(rows: DataFrame, state: DataFrame) -> DataFrame:
    """(ticker, at, n, a0, a1, b0, b1): rows and bounds of each slice of the ranges in ``state``."""
    joined = rows.join(small_side(state), "ticker")
    inside = F.col("_a").between(F.col("a0"), F.col("a1")) & ((F.col("a0") < F.col("a1")) | F.col("_b").between(F.col("b0"), F.col("b1")))
    by_a = F.col("a0") < F.col("a1")
    value, low = F.when(by_a, F.col("_a")).otherwise(F.col("_b")), F.when(by_a, F.col("a0")).otherwise(F.col("b0"))
    high = F.when(by_a, F.col("a1")).otherwise(F.col("b1"))
    # In decimals: a range of hashes is wider than a LONG.
    wide = "decimal(38,0)"
    width = F.ceil((high.cast(wide) - low.cast(wide) + 1) / F.lit(SLICES).cast(wide)).cast(wide)
    at = F.floor((value.cast(wide) - low.cast(wide)) / width).cast("int")
    bounds = (F.min("_a").alias("a0"), F.max("_a").alias("a1"), F.min("_b").alias("b0"), F.max("_b").alias("b1"))
    return joined.where(inside).groupBy("ticker", "need", at.alias("at")).agg(F.count("*").alias("n"), *bounds)


def cuts(rows: DataFrame, rank: Column, most: int) -> DataFrame:
    """(ticker, a, b): for each ticker of ``rows`` (ticker, _a, _b) a value that its row of ``rank`` from the end is at or after.

    ``rank`` may use ``n``, the ticker's rows; a ticker of fewer rows is taken whole.  At most ``most`` rows at or
    after the value have a lower rank, but for rows of one value.  Stored.
    """
    whole = rows.groupBy("ticker").agg(F.count("*").alias("n"), F.min("_a").alias("a0"), F.max("_a").alias("a1"), F.min("_b").alias("b0"), F.max("_b").alias("b1"))
    state = durable(whole.withColumn("need", rank.cast("long")))
    found = None
    while True:
        # Done: few enough rows before the wanted one, or a single value.
        done = (F.col("n") - F.col("need") < F.lit(most)) | ((F.col("a0") == F.col("a1")) & (F.col("b0") == F.col("b1")))
        part = state.where(done).select("ticker", F.col("a0").alias("a"), F.when(F.col("a0") < F.col("a1"), F.lit(-(1 << 63))).otherwise(F.col("b0")).alias("b"))
        found = part if found is None else found.unionByName(part)
        state = state.where(~done)
        if state.isEmpty():
            return durable(found)
        counted = _sliced(rows, state.drop("n"))
        after = Window.partitionBy("ticker").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
        ranked = counted.withColumn("above", F.coalesce(F.sum("n").over(after), F.lit(0)))
        holds = ranked.where((F.col("above") < F.col("need")) & (F.col("above") + F.col("n") >= F.col("need")))
        state = durable(holds.select("ticker", "n", "a0", "a1", "b0", "b1", (F.col("need") - F.col("above")).alias("need")))
