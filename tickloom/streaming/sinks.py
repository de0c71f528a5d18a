"""One read of a message stream, several tables: ticks, rejects and a summary by day.

Each micro-batch writes its parts of all tables and then lists them in one version
(``sources.versions``) under its batch number.  A batch that runs again after a stop finds
its number in the list and does nothing, or else writes its unlisted parts anew; so no
table has a row twice, and none is ahead of the others.

``ticks`` holds accepted ticks by ticker.  ``rejects`` holds messages that are no tick, as
they came, with their place and the reason.  ``days`` counts the ticks of each ticker and
day and has the last of them; readers add up its rows, so late ticks need no correction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.series import day_number
from ..schema import LAKE_SCHEMA
from ..sources.versions import Part, Versions
from .ingest import REJECT_SCHEMA, judged

TICKS, REJECTS, DAYS = "ticks", "rejects", "days"
DAY_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("day", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("last_seq", T.LongType()),
    ]
)
_TICK_COLUMNS = LAKE_SCHEMA.names
#: Rows of a part that compaction leaves alone, and of a part that it makes.
LARGE_PART = 8_000_000


def by_day(ticks: DataFrame) -> DataFrame:
    """Count and last tick of each ticker and day."""
    last = F.max(F.struct("event_time", "seq"))
    days = ticks.groupBy("ticker", day_number(ticks).alias("day")).agg(F.count("*").alias("n"), last.alias("last"))
    return days.select("ticker", "day", "n", F.col("last.event_time").alias("last_time"), F.col("last.seq").alias("last_seq"))


def write_part(versions: Versions, ticks: DataFrame, name: str) -> int:
    """Ticks and their summary as an unlisted part; how many ticks it has."""
    ticks.select(*_TICK_COLUMNS).write.mode("overwrite").partitionBy("ticker").parquet(versions.folder(TICKS, name))
    written = versions.read(TICKS, LAKE_SCHEMA, [Part(name, 0)])
    by_day(written).coalesce(1).write.mode("overwrite").parquet(versions.folder(DAYS, name))
    return versions.read(DAYS, DAY_SCHEMA, [Part(name, 0)]).agg(F.sum("n")).first()[0] or 0


def _batch(root: str, after: Callable[[str], None] | None = None) -> Callable[[DataFrame, int], None]:
    def write(envelope: DataFrame, number: int) -> None:
        spark = envelope.sparkSession
        versions = Versions(spark, root)
        if any(p.batch == number for p in versions.parts()):
            return
        name = f"batch-{number}"
        rows = judged(envelope).persist()
        try:
            count = write_part(versions, rows.where("reason IS NULL"), name)
            if after:
                after(TICKS)
            rows.where("reason IS NOT NULL").select(*REJECT_SCHEMA.names).write.mode("overwrite").parquet(versions.folder(REJECTS, name))
        finally:
            rows.unpersist()
        if after:
            after(REJECTS)
        part = Part(name, count, number, (name,))
        versions.change(lambda now: None if any(p.batch == number for p in now) else [*now, part])

    return write


def start(envelope: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, after: Callable[[str], None] | None = None) -> StreamingQuery:
    """Write a message stream to the tables below ``root``.  ``after`` is called when a batch has written a table.

    A checkpoint belongs to one ``root``: batch numbers start at its beginning.
    """
    writer = envelope.writeStream.foreachBatch(_batch(root, after)).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def ticks(spark: SparkSession, root: str) -> DataFrame:
    """All accepted ticks."""
    return Versions(spark, root).read(TICKS, LAKE_SCHEMA).drop("part")


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """All messages that are no tick: value, topic, partition, offset, reason."""
    return Versions(spark, root).read(REJECTS, REJECT_SCHEMA).drop("part")


def days(spark: SparkSession, root: str) -> DataFrame:
    """Count and last tick of each ticker and day, over all batches."""
    rows = Versions(spark, root).read(DAYS, DAY_SCHEMA)
    last = F.max(F.struct("last_time", "last_seq"))
    return rows.groupBy("ticker", "day").agg(F.sum("n").alias("n"), last.alias("last")).select("ticker", "day", "n", "last.*")


def compact(spark: SparkSession, root: str, large: int = LARGE_PART) -> list[str]:
    """Pack small parts, in the order they came, into parts of up to ``large`` rows; the names of the new ones.

    Larger parts are not touched.  Safe beside a running stream: each new part takes the
    place of those it was made of in one version.
    """
    versions, made = Versions(spark, root), []
    groups: list[list[Part]] = [[]]
    for part in versions.parts():
        if part.rows >= large:
            continue
        if sum(p.rows for p in groups[-1]) + part.rows > large:
            groups.append([])
        groups[-1].append(part)
    for group in groups:
        if len(group) < 2:
            continue
        name = f"packed-{uuid.uuid4().hex}"
        rows = versions.read(TICKS, LAKE_SCHEMA, group).drop("part")
        count = write_part(versions, rows.repartitionByRange("ticker", "event_time").sortWithinPartitions("ticker", "event_time", "seq"), name)
        kept = versions.read(REJECTS, REJECT_SCHEMA, group).drop("part")
        kept.coalesce(1).write.mode("overwrite").parquet(versions.folder(REJECTS, name))
        names = {p.name for p in group}
        new = Part(name, count, None, tuple(x for p in group for x in p.of))
        batches = [p.batch for p in group if p.batch is not None]
        # The newest batch number stays known, so that a batch that runs again finds it.
        new = Part(name, count, max(batches, default=None), new.of)

        def swapped(now: list[Part]) -> list[Part] | None:
            if not names <= {p.name for p in now}:
                return None
            place = min(i for i, p in enumerate(now) if p.name in names)
            rest = [p for p in now if p.name not in names]
            return [*rest[:place], new, *rest[place:]]

        if name in {p.name for p in versions.change(swapped)}:
            made.append(name)
    return made
