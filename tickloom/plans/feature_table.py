"""The feature table of a growing lake: only what new ticks touch is computed again.

A row's features depend on the ``LOOKBACK`` ticks before it and its target on ``horizon``
ticks after it.  So a new tick, late or not, changes the rows of its own day and those
within these bounds, which the counts by day (``streaming.sinks.days``) place in days.  An
update computes the rows of these days again, reads the days of their context beside them,
and writes them as a new part, together with the list of (ticker, day) it stands for; a
reader takes each (ticker, day) from the newest part that lists it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import LOOKBACK, SERVING, Profile, features
from ..operators.series import Size, day_number, day_ranges, in_days, small_side
from ..schema import FEATURES, LAKE_SCHEMA
from ..session import durable
from ..sources.versions import Part, Versions
from ..streaming import sinks

ROWS, DAYS = "rows", "days"
_ROW_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        *(T.StructField(f, T.LongType() if f == "volume" else T.DoubleType()) for f in FEATURES),
        T.StructField("target", T.DoubleType()),
        T.StructField("ticker", T.StringType()),
    ]
)
_DAY_SCHEMA = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("day", T.LongType())])


def touched(days: DataFrame, new: DataFrame, profile: Profile) -> DataFrame:
    """(ticker, day, again, n): days to read; ``again`` where rows change.

    ``days`` counts all ticks (ticker, day, n), ``new`` lists (ticker, day) that got ticks.
    Ticks of a ticker are numbered through; a day holds the numbers from ``low`` to ``high``.
    """
    series = Window.partitionBy("ticker").orderBy("day")
    upto, on = series.rowsBetween(Window.unboundedPreceding, 0), series.rowsBetween(0, Window.unboundedFollowing)
    high = F.sum("n").over(upto)
    marked = days.join(new.select("ticker", "day", F.lit(True).alias("is_new")), ["ticker", "day"], "left")
    placed = marked.select("ticker", "day", "n", (high - F.col("n")).alias("low"), high.alias("high"), F.coalesce("is_new", F.lit(False)).alias("is_new"))
    ends = placed.withColumns({"before": F.max(F.when(F.col("is_new"), F.col("high"))).over(upto), "after": F.min(F.when(F.col("is_new"), F.col("low"))).over(on)})

    def within(back: int, ahead: int):
        """Days with a tick at most ``ahead`` after a new day or ``back`` before one."""
        late = F.coalesce(F.col("low") < F.col("before") + ahead, F.lit(False))
        return late | F.coalesce(F.col("high") > F.col("after") - back, F.lit(False))

    flagged = ends.select("ticker", "day", "n", "low", "high", within(profile.horizon, LOOKBACK).alias("again"))
    # Beside them, the context of the days that are computed again.
    last = F.max(F.when(F.col("again"), F.col("high"))).over(upto)
    first = F.min(F.when(F.col("again"), F.col("low"))).over(on)
    context = F.coalesce(F.col("low") < last + profile.horizon, F.lit(False)) | F.coalesce(F.col("high") > first - LOOKBACK, F.lit(False))
    return flagged.withColumn("context", context).where("again OR context").select("ticker", "day", "n", "again")


def update(spark: SparkSession, lake: str, table: str, profile: Profile = SERVING) -> Part | None:
    """Bring the feature table at ``table`` up to the lake of ``streaming.sinks`` at ``lake``; None if it is."""
    source, target = Versions(spark, lake), Versions(spark, table)
    known = {x for p in target.parts() for x in p.of}
    parts = source.parts()
    fresh = [p for p in parts if not set(p.of) <= known]
    if not fresh:
        return None
    summary = source.read(sinks.DAYS, sinks.DAY_SCHEMA, parts)
    days = summary.groupBy("ticker", "day").agg(F.sum("n").alias("n"))
    new = source.read(sinks.DAYS, sinks.DAY_SCHEMA, fresh).select("ticker", "day").distinct()
    wanted = durable(touched(days, new, profile))
    longest, total = wanted.groupBy("ticker").agg(F.sum("n").alias("n")).agg(F.max("n"), F.sum("n")).first()
    ticks = source.read(sinks.TICKS, LAKE_SCHEMA, parts).drop("part")
    ticks = in_days(ticks.withColumn("_day", day_number(ticks)), day_ranges(wanted.select(F.col("day").alias("low"), F.col("day").alias("high"))))
    marks = small_side(wanted.select("ticker", F.col("day").alias("_day"), "again"))
    rows = features(ticks.join(marks, ["ticker", "_day"]), profile, size=Size(longest or 0, total or 0)).where("again")
    name = f"update-{uuid.uuid4().hex}"
    rows.select(*_ROW_SCHEMA.names).write.partitionBy("ticker").parquet(target.folder(ROWS, name))
    wanted.where("again").select("ticker", "day").coalesce(1).write.parquet(target.folder(DAYS, name))
    seen = tuple(sorted({x for p in parts for x in p.of} - known))
    part = Part(name, 0, None, seen)

    def added(now: list[Part]) -> list[Part] | None:
        # Another update has been here meanwhile: this one's part may rest on fewer ticks.
        return None if {x for p in now for x in p.of} != known else [*now, part]

    return part if part in target.change(added) else update(spark, lake, table, profile)


def read(spark: SparkSession, table: str) -> DataFrame:
    """The feature rows, each (ticker, day) from the newest part that lists it."""
    versions = Versions(spark, table)
    parts = versions.parts()
    rows = versions.read(ROWS, _ROW_SCHEMA, parts)
    if not parts:
        return rows.drop("part")
    order = spark.createDataFrame([(p.name, i) for i, p in enumerate(parts)], "part string, number int")
    listed = versions.read(DAYS, _DAY_SCHEMA, parts).join(F.broadcast(order), "part")
    newest = durable(listed.groupBy("ticker", "day").agg(F.max_by("part", "number").alias("part")))
    newest = newest.select("ticker", F.col("day").alias("_day"), "part")
    return rows.withColumn("_day", day_number(rows)).join(small_side(newest), ["ticker", "_day", "part"], "left_semi").select(*_ROW_SCHEMA.names)
