"""Labelled training rows: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One row in so many is held out of all learning.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def usable(labels: DataFrame, label: str, limit: int) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """(doc_id, label, chosen) of all rows that may be learned from; about ``limit`` are chosen, half of them of each label.

    Also the count of rows by label, and the share of them that is chosen, by a hash of
    the id.  Null ids and labels other than 0 and 1 are no labels; an id with both labels has none.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    per_doc = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).alias("high")).where("label = high").drop("high")
    counts = {r["label"]: r["count"] for r in per_doc.groupBy("label").count().collect()}
    shares = {k: min(1.0, limit / 2 / n) for k, n in counts.items()}
    place = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for k, v in shares.items():
        share = F.when(F.col("label") == k, v).otherwise(share)
    return per_doc.withColumn("chosen", place < share), counts, shares


def sample(labels: DataFrame, label: str, limit: int) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """The rows of ``usable`` that are chosen."""
    rows, counts, shares = usable(labels, label, limit)
    return rows.where("chosen").drop("chosen"), counts, shares


def texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(label, text) of the documents of a bounded sample; the sample is broadcast, since its size is bounded."""
    return all_texts(docs, F.broadcast(chosen))


def all_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but doc_id, and text, of the documents of these rows."""
    others = [c for c in rows.columns if c != "doc_id"]
    ids = rows.select(F.col("doc_id").alias("__id"), *(F.col(c).alias(f"__{c}") for c in others))
    joined = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("__id"))
    return joined.select(*(F.col(f"__{c}").alias(c) for c in others), "text")
