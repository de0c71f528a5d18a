"""The stages of the pipeline, each by one operator of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, packing, partenum, substring, toxicity

NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier learns from the labels of ``sf_dir``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop(docs, toxicity.train(docs, labels))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id.

    Near copies share four fifths of their five-word shingles; the query of operator 10 has a bar of its own.
    """
    return partenum.keep_one(docs, NEAR_SHINGLE, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that a smaller doc_id has go; a text that loses some has its kept words joined by one space."""
    cut = substring.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text"))
    return _with_text(cut, docs, changed, text)


def _with_text(rows: DataFrame, docs: DataFrame, changed, text) -> DataFrame:
    """The columns of ``docs`` with new texts, and their lengths, where ``changed``."""
    columns = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*(F.when(changed, columns[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark of ``sf_dir`` go."""
    return decontaminate.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs)
