"""Ticks on Kafka: one topic per ticker, JSON values.

The connector is a package of the cluster
(``org.apache.spark:spark-sql-kafka-0-10_2.13``), not of this repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.scalar import topic_of
from ..schema import TOPIC_PREFIX


def reader_options(brokers: str = "localhost:9092", prefix: str = TOPIC_PREFIX) -> dict[str, str]:
    """Every ticker topic, from the start, also after the broker dropped old data."""
    # Option names and values of Spark's Kafka source.
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribePattern": f"{prefix}.*",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_stream(
    spark: SparkSession, brokers: str = "localhost:9092", max_offsets: int | None = None
) -> DataFrame:
    """The envelope of all ticker topics; ``max_offsets`` bounds one micro-batch."""
    options = reader_options(brokers)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def to_messages(ticks: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """(topic, value) of every tick; the ticker is upper case from here on.

    Works on a batch and on a stream.
    """
    if "timestamp" in ticks.columns:
        text = F.col("timestamp")
    elif dict(ticks.dtypes)["event_time"] == "timestamp_ntz":
        text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    body = F.struct(
        text.alias("timestamp"), F.upper("ticker").alias("ticker"), F.col("price"), F.col("volume")
    )
    return ticks.select(
        topic_of(F.col("ticker"), prefix).alias("topic"), F.to_json(body).alias("value")
    )


def writer_options(brokers: str = "localhost:9092") -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers}


def publish(messages: DataFrame, brokers: str = "localhost:9092", form: str = "kafka", **options: str) -> None:
    """Send a batch of messages; ``form`` may name another sink that takes (topic, value)."""
    messages.write.format(form).options(**writer_options(brokers), **options).save()


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    brokers: str = "localhost:9092",
    trigger: dict | None = None,
    form: str = "kafka",
    **options: str,
) -> StreamingQuery:
    """Send a stream of messages as it comes; ``checkpoint`` is where it goes on after a stop.

    The topic of each message is its ``topic`` column.
    """
    writer = messages.writeStream.format(form).options(**writer_options(brokers), **options)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()
