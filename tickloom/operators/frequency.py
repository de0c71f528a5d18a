"""How often keys occur."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_frequency(df: DataFrame, *keys: str) -> DataFrame:
    """(attribute, value, n) for several key columns.

    One aggregate per key: each scans its own column only, where stacking the
    keys would multiply the rows.
    """
    counts = [
        df.groupBy(F.col(key).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(key).alias("attribute"), "value", "n")
        for key in keys
    ]
    return reduce(DataFrame.unionByName, counts)


def hourly_frequency(df: DataFrame, time: Column) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour")).agg(F.count("*").alias("n"))


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent keys, ties by key."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(key)).limit(k)
