"""The tick lake: Parquet, one directory per ticker."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import parse_time
from ..operators.clean import one_ticker
from ..operators.series import ROWS_PER_TASK
from ..schema import LAKE_SCHEMA

TICK = ["ticker", "event_time", "seq", "price", "volume"]

# About 50 MB of ticks in one file, which one task sorts.
ROWS_PER_FILE = ROWS_PER_TASK


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path; empty when there is no such path."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    return [status.getPath().getName() for status in found]


def scan(spark: SparkSession, path: str, schema: T.StructType = LAKE_SCHEMA) -> DataFrame:
    """All ticks of a lake; no rows when the lake does not exist yet.

    Files written without ``event_time`` get it from the time's text, also beside newer
    ones; those that have it are read with filters on it pushed down, and passed over in
    the search for others by their statistics.  A lake written without ``seq`` has none
    here, which every ordered operator refuses; ``with_seq`` numbers it.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    ticks = spark.read.schema(schema).parquet(path)
    if not {"event_time", "timestamp"} <= set(schema.names):
        return ticks
    older = ticks.where("event_time IS NULL").withColumn("event_time", parse_time("timestamp"))
    return ticks.where("event_time IS NOT NULL").unionByName(older)


def scan_ticker(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    """The ticks of one ticker; reads that ticker's directory only."""
    return one_ticker(scan(spark, path), ticker)


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row instead of counting them."""
    return df.isEmpty()


def with_seq(raw: DataFrame, path: str) -> DataFrame:
    """Ticks of a lake that has no ``event_time`` and ``seq`` yet, numbered.

    The numbers are given by position, so they are stored at ``path`` once and
    read back: a task that runs again must not number anew.
    """
    numbered = raw.select(
        "timestamp",
        parse_time("timestamp").alias("event_time"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("price").cast("double").alias("price"),
        F.col("volume").cast("long").alias("volume"),
        F.col("ticker").cast("string").alias("ticker"),
    )
    numbered.write.mode("overwrite").partitionBy("ticker").parquet(path)
    return raw.sparkSession.read.schema(LAKE_SCHEMA).parquet(path)


def write(ticks: DataFrame, path: str, mode: str = "append") -> None:
    ticks.write.mode(mode).partitionBy("ticker").parquet(path)


def compact(
    ticks: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, files: int | None = None
) -> None:
    """Write the ticks to a new path in few, large, time-sorted files.

    Ranges over (ticker, event_time, seq) have even sizes whatever a ticker's
    or an instant's share is, and the narrow time range of each file lets a
    later filter on time skip it.
    """
    key = ["ticker", "event_time", "seq"]
    files = files or max(1, ceil(ticks.count() / rows_per_file))
    (
        ticks.repartitionByRange(files, *key)
        .sortWithinPartitions(*key)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("ticker")
        .parquet(path)
    )


def read_bars(
    spark: SparkSession, path: str, form: str = "parquet", schema: str | None = None, **options: str
) -> DataFrame:
    """A table of price bars, as Parquet, CSV or another format Spark reads; text formats need their schema."""
    reader = spark.read.format(form).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def bars_to_ticks(
    bars: DataFrame,
    ticker: Column | str,
    time: Column | str,
    close: Column | str,
    volume: Column | str,
    seq: Column | str,
) -> DataFrame:
    """Close and volume of each bar as a tick; open, high and low are not kept."""

    def col(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    return bars.select(
        col(ticker).cast("string").alias("ticker"),
        col(time).alias("event_time"),
        col(seq).cast("long").alias("seq"),
        col(close).cast("double").alias("price"),
        col(volume).cast("long").alias("volume"),
    )
