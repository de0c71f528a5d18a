"""Message stream to tick lake, exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import parse_time
from ..schema import MESSAGE_SCHEMA
from ..sources.lake import child_names

# A Kafka offset below 2**48 leaves the upper bits to the partition number.
_OFFSET_BITS = 48


def parse_ticks(envelope: DataFrame) -> DataFrame:
    """Envelope rows to tick rows, on a stream or a batch.

    A value that is no JSON object gives a row of nulls, a field of the wrong
    type a null, an unknown field nothing.  ``seq`` comes from the message's
    place in its topic, where the source has one.
    """
    fields = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    parsed = envelope.select(fields.alias("data"), message_seq(envelope).alias("seq"))
    return parsed.select(
        "data.timestamp",
        parse_time("data.timestamp").alias("event_time"),
        "seq",
        "data.price",
        "data.volume",
        "data.ticker",
    )


REJECT_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)


def message_seq(envelope: DataFrame) -> Column:
    """The number of a message's tick, from its place in the topic, where the source has one."""
    if {"partition", "offset"} <= set(envelope.columns):
        return F.shiftleft(F.col("partition").cast("long"), _OFFSET_BITS) + F.col("offset")
    return F.xxhash64("value")


def is_reject() -> Column:
    """A tick without ticker, price or a readable time."""
    return F.col("ticker").isNull() | F.col("price").isNull() | F.col("event_time").isNull()


def accepted(ticks: DataFrame) -> DataFrame:
    return ticks.where(~is_reject())


def rejects(ticks: DataFrame) -> DataFrame:
    return ticks.where(is_reject())


def judged(envelope: DataFrame) -> DataFrame:
    """The tick of each message beside the message itself, and why it is none (``reason``, null for a tick)."""
    text = F.col("value").cast("string")
    fields = F.from_json(text, MESSAGE_SCHEMA)
    place = [F.col(c) if c in envelope.columns else F.lit(None).cast(REJECT_SCHEMA[c].dataType).alias(c) for c in ("topic", "partition", "offset")]
    rows = envelope.select(text.alias("value"), *place, fields.alias("data"), message_seq(envelope).alias("seq"), F.try_parse_json(text).isNotNull().alias("_is_json"))
    ticks = rows.select(*REJECT_SCHEMA.names[:4], "seq", "_is_json", "data.*").withColumn("event_time", parse_time("timestamp"))
    return ticks.withColumn("reason", _reason()).drop("_is_json")


def _reason() -> Column:
    why = (
        F.when(F.col("value").isNull(), "no value")
        .when(~F.col("_is_json"), "no JSON")
        .when(F.col("ticker").isNull(), "no ticker")
        .when(F.col("price").isNull(), "no price")
        .otherwise("no time")
    )
    return F.when(is_reject(), why)


def start_ingest(
    envelope: DataFrame,
    lake: str,
    checkpoint: str,
    rejects_to: str | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Append a message stream to the lake, partitioned by ticker.

    Without ``rejects_to`` unreadable messages reach the lake as well, under
    the default partition.  With it, they go to a table of their own, as they came
    (``REJECT_SCHEMA``), by a second query.  ``trigger`` takes the arguments of ``DataStreamWriter.trigger``.
    """
    ticks = parse_ticks(envelope)
    if rejects_to is None:
        return [_append(ticks, lake, checkpoint, trigger)]
    return [
        _append(accepted(ticks), lake, f"{checkpoint}/accepted", trigger),
        _append(judged(envelope).where("reason IS NOT NULL").select(*REJECT_SCHEMA.names), rejects_to, f"{checkpoint}/rejects", trigger, None),
    ]


def _append(ticks: DataFrame, out: str, checkpoint: str, trigger: dict | None, by: str | None = "ticker") -> StreamingQuery:
    refuse_lost_checkpoint(ticks.sparkSession, out, checkpoint)
    writer = (
        ticks.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    if by:
        writer = writer.partitionBy(by)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_until_stopped(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for the queries; stop them all on an interrupt or at the timeout."""
    try:
        for query in queries:
            query.awaitTermination(timeout) if timeout else query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            query.stop()


def _last_batch(spark: SparkSession, folder: str) -> int:
    names = [name.removesuffix(".compact") for name in child_names(spark, folder)]
    return max((int(name) for name in names if name.isdigit()), default=-1)


def refuse_lost_checkpoint(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Fail when the output has seen more batches than the checkpoint knows of.

    The file sink skips batch numbers it has in its log, so a new checkpoint
    over an old output would drop data without a word.  The log may be one
    batch ahead: that is a stop between the write and the commit.
    """
    written = _last_batch(spark, f"{out}/_spark_metadata")
    committed = _last_batch(spark, f"{checkpoint}/commits")
    if written > committed + 1:
        raise ValueError(
            f"{out} holds batch {written}, but {checkpoint} has committed {committed}: "
            "use the checkpoint this output was written with, or a new output path"
        )
