"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_CHECKPOINT_DIR = "spark.checkpoint.dir"

# A broadcast side is a fact about data, so it is only hinted after counting it.
BROADCAST_ROWS = 200_000


def build_session(app: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may have none; one is made up then.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{_CHECKPOINT_DIR} must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tickloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/tickloom/{label}-{uuid.uuid4().hex}"


_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


#: For tables of models: a reader decodes a whole row group of nested columns at a time (4,096 rows at most), so it is
#: kept small in bytes; the decoded nodes of trees take some ten times as much.
MODEL_ROWS = {"parquet.block.size": str(4 << 20)}


def stored(df: DataFrame, label: str, by: str | None = None, more: Iterable[DataFrame] = (), options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder, for several passes over it.

    The rows of ``more`` are appended, each part before the next one is asked for.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, label)
    writer = df.write.options(**options or {})
    writer = writer.partitionBy(by) if by else writer
    writer.parquet(path)
    for part in more:
        part.select(*df.columns).write.mode("append").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def freed(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again; other tables stay as they are."""
    for table in tables:
        if path := _places.pop(table, None):
            removed(table.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``work_path`` named, by the file system that wrote it.

    A folder that cannot be deleted costs space but no results, so that is only a warning.
    """
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    except Exception as failure:  # noqa: BLE001
        warnings.warn(f"{path} is left behind: {failure}", stacklevel=2)


@contextmanager
def bytes_per_batch(spark: SparkSession, most: str = "8m") -> Iterator[None]:
    """Queries that run meanwhile hand at most so many bytes at a time to Python, where a row may be large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def arrow_types(schema: StructType | str) -> pa.Schema:
    """The Arrow schema of rows that a task passes on; a text schema needs the driver."""
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema, prefers_large_types=False)


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, on storage that outlives the executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
