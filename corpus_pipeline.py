"""From raw documents to packed sequences: five stages, each one operator of ``tickloom.llm``.

A stage takes (spark, docs, folder) and returns a DataFrame; all but the last return
the columns of ``docs``.  ``run`` writes each stage's result to the shared folder
and hands the written table on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import stages
from tickloom.llm.store import staged

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("ngram_jaccard_join", stages.keep_one_of_near_copies),
    ("substring_dedup", stages.cut_repeats),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("best_fit_packing", stages.pack),
]

#: Classifier, templates and tokenizer have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
